"""Small tables with the cases that every operator must stand."""

import random

from pyspark.sql import types as T

#: Names that operators use for columns of their own.
CLASHES = ("doc", "row", "n", "size", "shard", "score", "kept", "rejected", "pos", "bucket", "grp", "_doc",
           "_row", "root", "token", "start", "block", "copies", "_set", "lang_pred", "held_out", "x", "_own_1")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

WORDS = {
    "xa": "bado kimu lopi satu vemo rani dofu gile".split(),
    "xb": "strünk plöck grumt schwelk drangt kropf flinz wrusk".split(),
}


def prose(rng, lang, n):
    """Invented words in lines of a few."""
    words = [rng.choice(WORDS[lang]) + rng.choice(["", rng.choice(WORDS[lang])]) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 9]) for i in range(0, n, 9))


def documents(seed=3, n=60):
    """Prose of two languages, and: null, empty, blank and letterless texts, one very long
    text, copies and near copies, shared lines, repeated rows, null ids, languages and sources."""
    rng = random.Random(seed)
    texts = [(prose(rng, lang, rng.randint(1, 160)), lang) for lang in rng.choices(["xa", "xb"], k=n)]
    base = prose(rng, "xa", 120)
    near = base.split(" ")
    near[60] = "ANDERS"
    line = "The very same closing line."
    texts += [
        (None, "xa"), ("", "xa"), (" \n\t\n ", "xb"), ("123 !! 45\n", None),
        (prose(rng, "xb", 9000), "xb"),
        (base, "xa"), (base, "xa"), (" ".join(near), "xa"), (base.upper(), None),
        (prose(rng, "xa", 40) + "\n" + line, "xa"), ("  " + line.upper() + "\t\n" + prose(rng, "xb", 30), "xb"),
        (line + "\n" + line + "\nshort", "xa"), ("a b", "xa"), ("a b", "xa"), ("one", None), ("a  b", "xb"),
        ("word " * 300, "xa"), ("\n".join([line] * 5), "xb"),
    ]
    sources = ["s1", "s2", "é3", "S4", None]
    rows = [(i, t, lang, sources[i * i % 7 % 5], len(t or "")) for i, (t, lang) in enumerate(texts)]
    rows += [rows[-4], rows[3], (None, base, "xa", "s1", 5), (None, None, None, None, None), (7, base, "xa", "s2", 1)]
    return rows


def frame(spark, rows, clashes=True, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return df.selectExpr("*", *[f"'{c}!' as `{c}`" for c in CLASHES]) if clashes else df


def empty(spark):
    return frame(spark, [])


def plain(rows):
    """Rows of a result as sorted tuples."""
    return sorted((tuple(r) for r in rows), key=repr)
