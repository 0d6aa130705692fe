"""Micro-batch loading: each batch of change files becomes one committed version."""

import tempfile

from conftest import full_frame, rows_of, ts
from test_golden_jobs import EML_SRC, EML_TGT, calendar

from martloom.plans import email
from martloom.sources.snapshot import SnapshotStore
from martloom.streaming import start_incremental_load


def test_each_micro_batch_is_one_version(spark):
    inbox = tempfile.mkdtemp(prefix="ml-inbox-")
    batches = [
        [dict(eml_ky=1, src_cd="X", row_updt_tms=ts("2024-01-10 01:00:00"), row_stat_cd="NEW"),
         dict(eml_ky=2, src_cd="X", row_updt_tms=ts("2024-01-10 02:00:00"), row_stat_cd="NEW")],
        [dict(eml_ky=1, src_cd="X", row_updt_tms=ts("2024-01-11 01:00:00"), row_stat_cd="DEL"),
         dict(eml_ky=3, src_cd="Y", row_updt_tms=ts("2024-01-11 02:00:00"), row_stat_cd="NEW")],
    ]
    for i, rows in enumerate(batches):
        full_frame(spark, EML_SRC, rows).coalesce(1).write.parquet(f"{inbox}/part={i}")
    schema = full_frame(spark, EML_SRC, []).schema
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(inbox)
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    cal = calendar(spark)
    q = start_incremental_load(
        changes, store, "eml", "EML_PROMO_KY", lambda b, t, w, hw: email.run(b, t, cal, w, hw),
        schema=full_frame(spark, EML_TGT, []).schema, checkpoint_location=tempfile.mkdtemp(prefix="ml-chk-"),
        initial_high_water=100, available_now=True)
    q.awaitTermination(120)
    st = store.state()
    assert st.version == 2 and st.high_water["EML_PROMO_KY"] == 103 and st.stats["epoch"] == 1
    assert rows_of(store.read(), ["eml_promo_ky", "eml_ky", "src_cd", "row_stat_cd"]) == [
        (101, 1, "X", "DEL"), (102, 2, "X", "NEW"), (103, 3, "Y", "NEW")]


def test_replayed_epoch_is_skipped(spark):
    from martloom.streaming import load_micro_batch

    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    cal = calendar(spark)
    batch = full_frame(spark, EML_SRC, [dict(eml_ky=1, src_cd="X", row_updt_tms=ts("2024-01-10 01:00:00"),
                                             row_stat_cd="NEW")])
    job = lambda b, t, w, hw: email.run(b, t, cal, w, hw)
    schema = full_frame(spark, EML_TGT, []).schema
    assert load_micro_batch(batch, 0, store, "eml", "K", job, schema=schema, initial_high_water=0)
    assert not load_micro_batch(batch, 0, store, "eml", "K", job, schema=schema)  # replay
    st = store.state()
    assert st.version == 1 and st.high_water["K"] == 1 and store.read().count() == 1


def test_streams_lose_no_rows_and_apply_none_twice(spark):
    """A second query starts at epoch 0 again; a batch run between micro-batches does not forget
    the epochs; rows without a change time are loaded."""
    from martloom.plans.runner import run_load
    from martloom.streaming import load_micro_batch

    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    cal = calendar(spark)
    schema = full_frame(spark, EML_TGT, []).schema
    job = lambda b, t, w, hw: email.run(b, t, cal, w, hw)

    def batch(key, when="2024-01-10 01:00:00"):
        return full_frame(spark, EML_SRC, [dict(eml_ky=key, src_cd="X", row_updt_tms=when and ts(when), row_stat_cd="NEW")])

    def load(key, epoch, query, when="2024-01-10 01:00:00"):
        return load_micro_batch(batch(key, when), epoch, store, "eml", "K", job, schema=schema, initial_high_water=0, query_id=query)

    assert load(1, 0, "q1")
    run_load(store, "eml", "K", lambda t, w, hw: email.run(batch(7, "2030-01-01 00:00:00"), t, cal, w, hw), schema=schema)
    assert not load(1, 0, "q1")
    assert load(2, 0, "q2")
    assert load(3, 1, "q2", None)
    assert not load(3, 1, "q2", None)
    assert sorted(r[0] for r in store.read().select("eml_ky").collect()) == [1, 2, 3, 7]
    assert store.state().epochs == {"q1": 0, "q2": 1}
