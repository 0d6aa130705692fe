import random

import pytest

from martloom.llm import line_dedup


def brute(docs, least):
    """docs: (id, text), distinct; text after deletion per document, in order of (id, NULL last)."""
    rows = []
    for i, t in docs:
        lines = t.split("\n")
        rows.append((i, lines, [k for k, x in enumerate(lines) if x.split()]))
    seen, gone = {}, [set() for _ in rows]
    runs = []
    for d, (_, lines, seats) in enumerate(rows):
        for a in range(len(seats)):
            words = 0
            for b in range(a, min(a + least, len(seats))):
                words += len(lines[seats[b]].split())
                content = tuple(lines[s] for s in seats[a : b + 1])
                runs.append((d, a, b, content, words))
    for d, a, _, content, _ in runs:
        seen[content] = min(seen.get(content, (d, a)), (d, a))
    for d, a, b, content, words in runs:
        if words >= least and seen[content] < (d, a):
            gone[d].update(rows[d][2][a : b + 1])
    return [(i, "\n".join(x for k, x in enumerate(lines) if k not in g), len(lines), len(g))
            for (i, lines, _), g in zip(rows, gone, strict=True)]


def corpus(seed, n, words):
    rng = random.Random(seed)
    common = [" ".join(rng.choice("ab") for _ in range(rng.randint(1, words))) for _ in range(6)]
    docs = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 9)):
            lines.append(rng.choice([*common, "", f"own {i} {rng.random()}", common[0], common[1]]))
        docs.append((i, "\n".join(lines)))
    return docs


@pytest.mark.parametrize(("seed", "least"), [(1, 3), (2, 7)])
def test_against_brute_force(spark, make_docs, seed, least):
    docs = corpus(seed, 60, 5)
    out = line_dedup.dedup_lines(make_docs(docs), least).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_deleted) for r in out) == sorted(brute(docs, least))
    assert all(r.n_left == len(r.text.split()) for r in out)


def test_rows(spark, make_docs):
    line = "one two three four five six seven eight nine ten eleven"
    long = "\n".join(f"line {k} of a very long text with more than ten words in it" for k in range(3000))
    docs = make_docs([(1, line), (2, f"{line}\nmore"), (2, f"{line}\nmore"), (3, None), (4, ""), (None, f"x\n{line}"),
                      (5, long), (6, long), (7, f"{line}\n{line}")])
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_deleted", "n_left"]
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.text, r.n_deleted) for r in out.collect()), key=str)
    by = {(i, gone): t for _, i, t, gone in rows}
    assert len(rows) == 9
    assert by[1, 0] == line and by[2, 1] == "more" and by[3, 0] is None and by[4, 0] == "" and by[0, 1] == "x"
    assert by[5, 0] == long and by[6, 3000] == "" and by[7, 2] == ""
    assert line_dedup.dedup_lines(make_docs([])).count() == 0
