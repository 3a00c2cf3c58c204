import hashlib

from landfall.llm import line_dedup as D
from tests.llm import samples

LAST = 2**63 - 1


def expected(rows, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(LAST if i is None else i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        gone = [len(key(x)) >= least and min(holders[key(x)]) != (LAST if i is None else i) for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, len(lines), sum(gone), kept))
    return out


def digests(rows):
    return sorted(((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in expected(rows)), key=repr)


def test_matches_brute_force(spark):
    rows = samples.documents() + [(900, "ÀÉÎ ÀÉÎ ÀÉÎ\nSame line as below", None, None, 0), (901, "àéî àéî àéî\nsame LINE as below", None, None, 0)]
    assert samples.plain(D.line_digests(samples.frame(spark, rows)).collect()) == digests(rows)


def test_hot_line_over_many_partitions(spark):
    hot = "every document holds this line"
    rows = [(i, f"{hot}\nown line number {i}\n{hot}", None, None, 0) for i in range(4000)]
    docs = samples.frame(spark, rows, parts=8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert samples.plain(D.line_digests(docs).collect()) == digests(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_texts_without_their_lines(spark):
    rows = samples.documents()
    docs = samples.frame(spark, rows)
    out = D.drop_lines(docs)
    assert out.columns == docs.columns
    kept = sorted(((i, None if t is None else k) for (i, t, *_), (_, _, _, k) in zip(rows, expected(rows))), key=repr)
    assert samples.plain(out.select("doc_id", "text").collect()) == kept
    assert out.select("score").distinct().collect()[0][0] == "score!"


def test_bitmaps_round_trip(spark):
    rows = samples.documents()
    maps = {(r["doc"], r["row"]): r for r in D.keep_bitmaps(samples.frame(spark, rows)).collect()}
    assert sum(r["n_dropped"] for r in maps.values()) > 0
    assert all(isinstance(r["bitmap"], (bytes, bytearray)) for r in maps.values())


def test_empty(spark):
    assert D.line_digests(samples.empty(spark)).collect() == []
    assert D.drop_lines(samples.empty(spark)).collect() == []
