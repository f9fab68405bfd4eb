from collections import defaultdict

from veritrail.llm.line_dedup import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs):
    seen = defaultdict(set)
    for n, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            seen[key(line)].add(n)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or len(seen[key(x)]) < min_docs]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_against_brute_force(spark):
    # É and é differ by a lead-byte twin under Latin-1 lowering; they must stay different keys
    pool = ["Shared line", "  shared LINE\t", "É clair", "é clair", "ÃƒÂ", "ãƒâ", "\x0b\r", "", "own %d", "x ", "İ", "ı", "日本", "×", "÷", "B　"]
    rows = []
    for n in range(60):
        lines = [(pool[(n * 7 + k * 3) % len(pool)]).replace("%d", str(n)) for k in range(n % 9)]
        rows.append((n, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "\n\n"), (None, "shared line\nabc"), (None, "shared line\nabc"), (5, rows[5][1]), (80, "\n".join(["Shared line"] * 5000 + [f"u{i}" for i in range(5000)]))]
    for least in (2, 5, 10):
        frame = spark.createDataFrame([(t, "p", i, 9) for i, t in rows], "text string, pos string, doc_id long, k1 int")
        got = line_dedup(frame, min_docs=least)
        assert got.columns == ["text", "pos", "doc_id", "k1", "_n_lines", "_n_dropped"]
        assert sorted((str(r.doc_id), r._n_lines, r._n_dropped, r.text) for r in got.collect()) == brute(rows, least)


def test_clashing_names_are_replaced(spark):
    got = line_dedup(spark.createDataFrame([(1, "a", 7, 8)], "doc_id long, text string, _n_lines int, _n_dropped int"))
    assert [tuple(r) for r in got.collect()] == [(1, "a", 1, 0)] and got.columns == ["doc_id", "text", "_n_lines", "_n_dropped"]


def test_no_rows(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_line_goes(spark):
    got = line_dedup(spark.createDataFrame([(i, "a\nA ") for i in range(3)], "doc_id long, text string"), min_docs=2).collect()
    assert [(r.text, r._n_lines, r._n_dropped) for r in got] == [("", 2, 2)] * 3
