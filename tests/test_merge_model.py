"""apply_changes against a brute-force Python model of MERGE followed by the loopback."""

import os
from datetime import datetime

from conftest import frame
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.operators.merge import apply_changes

OLD, RUN, LATER = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
T_COLS = {"k": "bigint", "v": "string", "fk": "bigint", "row_insrt_tms": "ts", "row_updt_tms": "ts",
          "row_stat_cd": "string"}
S_COLS = {"k": "bigint", "v": "string", "fk": "bigint", "row_stat_cd": "string", "d": "bool", "n": "bool"}

vals = st.sampled_from([None, "a", "b"])
fks = st.sampled_from([None, -1, 0, 1, 2])
stats = st.sampled_from([None, "NEW", "UPDT", "DEL"])


def model(target, source, only_nonzero):
    by_key = {s[0]: s for s in source}
    out = []
    for k, v, fk, ins, upd, status in target:
        s = by_key.get(k)
        if s is not None and s[4]:  # merge
            v = s[1]
            status = "DEL" if s[3] == "DEL" else "UPDT"
            upd = RUN
        elif s is not None:  # loopback
            nz = fk is not None and fk != 0
            if upd < RUN and (nz or not only_nonzero) and s[2] is not None and fk is not None and s[2] != fk:
                fk, upd = s[2], RUN
        out.append((k, v, fk, ins, upd, status))
    have = {t[0] for t in target}
    for k, v, fk, status, d, _ in source:
        if d and k not in have:
            out.append((k, v, fk, RUN, RUN, "DEL" if status == "DEL" else "NEW"))
    return sorted(out, key=repr)


@settings(max_examples=int(os.environ.get("MODEL_EXAMPLES", "8")), deadline=None)
@given(
    tkeys=st.sets(st.integers(0, 9), max_size=7),
    skeys=st.sets(st.integers(0, 12), max_size=8),
    data=st.data(),
    only_nonzero=st.booleans(),
    use_new_flag=st.booleans(),
)
def test_apply_changes_matches_model(spark, tkeys, skeys, data, only_nonzero, use_new_flag):
    target = [(k, data.draw(vals), data.draw(fks), OLD, data.draw(st.sampled_from([OLD, RUN, LATER])),
               data.draw(stats)) for k in sorted(tkeys)]
    source = [(k, data.draw(vals), data.draw(fks), data.draw(stats), data.draw(st.booleans()), k not in tkeys)
              for k in sorted(skeys)]
    out = apply_changes(
        frame(spark, T_COLS, target), frame(spark, S_COLS, source), ["k"], run_ts=RUN,
        update_cols=["v"], insert_cols=["v", "fk"], repair_cols=["fk"], delta_flag="d",
        new_flag="n" if use_new_flag else None, repair_only_nonzero=only_nonzero,
    )
    got = sorted((tuple(r) for r in out.select(*T_COLS).collect()), key=repr)
    assert got == model(target, source, only_nonzero)
