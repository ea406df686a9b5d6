import random

from pyspark.sql import functions as F

from daycast.llm.line_dedup import dedup_lines

SPACE = " \t\n\x0b\f\r"


def plain(rows, min_chars=10, min_docs=2):
    """{(doc_id, text): (kept, lines, dropped)} by the contract's words."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))

    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(d)
    out = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(holders.get(key(x), ())) < min_docs or min(holders[key(x)]) == d]
        out[d, t] = "\n".join(kept), len(lines), len(lines) - len(kept)
    return out


def check(docs, rows, **kw):
    got = dedup_lines(docs(rows), **kw).collect()
    assert len(got) == len(rows)
    want = plain(rows, **kw)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(want[d, t])
    for r in got:
        assert (r.text, r.n_lines, r.n_dropped) in texts[r.doc_id]
    return got


EDGES = [
    (5, "A shared line here\nown line of five\nA SHARED LINE HERE"), (3, "  a shared line here\t\nother\n"), (9, "\ta shared LINE here \x0b"),
    (7, None), (8, ""), (10, "short\nshort"), (11, "short\n\n\n"), (12, "ÉCOLE normale supérieure"), (13, "école normale supérieure"),
    (14, "ÉCOLE normale SUPérieure"), (None, "a shared line here"), (None, None), (15, "123456789"), (16, "123456789"), (17, "1234567890"), (18, "1234567890"),
    (19, " \n \t \n"), (20, "ééééééééé"), (21, "ééééééééé"), (22, "éééééééééé"), (23, "éééééééééé"),
]


def test_edges(docs):
    check(docs, EDGES)


def test_repeated_rows_and_versions(docs):
    rows = [(1, "a line that repeats"), (1, "a line that repeats"), (1, "another text\na line that repeats"), (2, "a line that repeats\nend"), (2, "end of two lines")]
    got = check(docs, rows)
    assert sum(r.n_dropped for r in got) == 1


def test_columns_are_carried(docs):
    row = dedup_lines(docs([(1, "x")])).first().asDict()
    assert row["hash"] == "kept" and row["a.b"] == "x" and row["n_lines"] == 1 and row["__n"] == 3 and "N_Lines" not in row


def test_threshold_of_documents(docs):
    rows = [(i, "this line is in many\nthis one in two" if i < 2 else "this line is in many") for i in range(4)]
    check(docs, rows, min_docs=3)
    check(docs, rows, min_chars=17)


def test_long_and_random_texts(docs):
    rng = random.Random(3)
    lines = [f"line number {i} of the pool" for i in range(40)] + ["tiny", ""]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows.append((60, "\n".join(f"own {i}" * 3 for i in range(20000)) + "\nline number 1 of the pool"))
    check(docs, rows)


def test_empty_table(docs):
    out = dedup_lines(docs([]))
    assert out.count() == 0 and dict(out.dtypes)["n_dropped"] == "bigint"


def test_main_path_is_native(docs):
    plan = dedup_lines(docs([(1, "x")])).select(F.col("text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
