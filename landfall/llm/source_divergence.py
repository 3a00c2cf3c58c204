"""Audit of how the sources of a language differ in their terms, exact to the integer.

Each kept term of a language is a row: its nonzero counts in the order of the sources.
Rows are inserted, with their multiplicities, into frequent-pattern trees. The divergence
of two sources is what it would be if no term occurred in either, corrected for terms in
one of them, corrected once more for terms in both. That last correction depends on two
counts only, so a tree computes it once for each node and ancestor, and counts it as often
as rows share the path.

The rows are sorted over the cluster, and a task that reads a sorted range holds of its
tree only the path to the current row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import stored, utf8_texts
from landfall.operators.lookup import is_small

#: Letters are A-Z, a-z and all that is not ASCII; only A-Z change case. Other bytes part terms.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, count long, docs long"
_PAIRS = "lang string, source string, item string, value decimal(38,0)"


@dataclass(frozen=True)
class Audit:
    least_documents: int = 3  # of its language that a kept term is in
    unit: int = 1_000_000_000
    term_ranks: int = 200
    held_terms: int = 200_000  # of a task while it counts
    combinations: int = 2_000_000  # of nodes and ancestors in one step of a tree


def count_terms(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, source, term, count, docs): occurrences, and rows that hold the term; partial sums.

    A null term stands for each lang and source that occurs. Tasks add up terms in a store
    of bounded size before anything is shuffled.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), utf8_texts(batch["text"])):
                if (own := counts.get((lang, source))) is None:
                    own = counts[lang, source] = Counter(), Counter()
                if text is not None:
                    terms = text.tobytes().translate(_LETTERS).split()
                    own[0].update(terms)
                    own[1].update(set(terms))
            if sum(len(c) for c, _ in counts.values()) >= audit.held_terms:
                yield from _counted(counts)
                counts.clear()
        yield from _counted(counts)

    texts = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text"
    )
    return texts.mapInArrow(tally, _COUNTS)


def _counted(counts: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (occurrences, documents) in counts.items():
        n = len(occurrences) + 1
        terms = pa.array([None, *occurrences], pa.binary()).view(pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), terms,
                pa.array([0, *occurrences.values()], pa.int64()), pa.array([0, *[documents[t] for t in occurrences]], pa.int64()),
            ],
            names=["lang", "source", "term", "count", "docs"],
        )


def kept_terms(docs: DataFrame, audit: Audit) -> DataFrame:
    """(lang, term, total, items): each kept term and its (source, count) in the order of the sources.

    A null term has all sources of the language. An array has at most one item per source.
    """
    # One shuffle serves both aggregations.
    partial = count_terms(docs, audit).repartition("lang", "term")
    counts = partial.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    rows = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("total"),
        F.sort_array(F.collect_list(F.struct("source", "count"))).alias("items"),
    )
    return rows.where(F.col("term").isNull() | (F.col("docs") >= audit.least_documents)).select("lang", "term", "total", "items")


def _share(count: str, n: str, audit: Audit) -> Column:
    """1 + floor(unit * (count + 1) / (n + v)); null without a kept term."""
    whole = f"cast({audit.unit} as decimal(10,0)) * cast({count} + 1 as decimal(19,0)) div cast({n} + v as decimal(19,0))"
    return F.expr(f"case when v > 0 then 1 + {whole} end")


def _gap(p: str, q: str) -> Column:
    """floor((p - q)**2 / q) of shares, which are at most unit + 1."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def groups_of(kept: DataFrame, audit: Audit) -> DataFrame:
    """(lang, source, n, v, n_lang, base): a row for every group, base the share of a term it lacks."""
    terms = kept.where("term is not null")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    sizes = terms.select("lang", F.inline("items")).groupBy("lang", "source").agg(F.sum("count").alias("n"))
    found = kept.where("term is null").select("lang", F.inline("items")).drop("count")
    rows = found.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    rows = rows.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "n_lang")])
    return rows.withColumn("base", _share("0", "n", audit))


def _with_lang(rows: DataFrame, by_lang: DataFrame, small: bool) -> DataFrame:
    """Join what is known of a language; a hot language is split by adaptive execution where it is no broadcast."""
    return rows.join(F.broadcast(by_lang) if small else by_lang, "lang")


def _both(anc: np.ndarray, node: np.ndarray, p: np.ndarray, base: np.ndarray) -> np.ndarray:
    """What the gap from node's share to ancestor's is more than both single corrections say."""
    def gap(x: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (x - q) ** 2 // q

    return gap(p[node], p[anc]) - gap(p[node], base[anc]) - gap(base[node], p[anc]) + gap(base[node], base[anc])


class _Tree:
    """A frequent-pattern tree of sorted rows, one language and one step at a time."""

    def __init__(self, combinations: int):
        self.combinations = combinations
        self.lang: str | None = None
        self._clear()

    def _clear(self) -> None:
        self.path: list[tuple] = []  # (source, p, base, node) from the root to the last row's end
        self.sources: list[str] = []
        self.shares: list[tuple[int, int]] = []
        self.rows: list[int] = []  # of each node, how many terms pass through it
        self.ancestors: list[np.ndarray] = []
        self.nodes: list[np.ndarray] = []
        self.n_combinations = self.n_terms = 0

    def insert(self, items: list[tuple], terms: int) -> None:
        """Add a row of (source, p, base) that ``terms`` terms have."""
        same = 0
        for (*item, _), new in zip(self.path, items):
            if tuple(item) != new:
                break
            same += 1
        del self.path[same:]
        for source, p, base in items[same:]:
            self.path.append((source, p, base, len(self.rows)))
            self.sources.append(source)
            self.shares.append((p, base))
            self.rows.append(0)
        ids = np.fromiter((x[3] for x in self.path), np.int64, len(items))
        for at in ids.tolist():
            self.rows[at] += terms
        self.n_terms += terms
        if same < len(items):
            # Every new node with each of its ancestors.
            depth, above = np.tril_indices(len(items), -1)
            new = slice(same * (same - 1) // 2 if same else 0, None)
            self.nodes.append(ids[depth[new]])
            self.ancestors.append(ids[above[new]])
            self.n_combinations += len(self.nodes[-1])

    def corrections(self) -> pa.RecordBatch | None:
        """(lang, source, item, value) of all nodes with their ancestors, and start a new tree."""
        rows: list[tuple] = []
        if self.n_combinations:
            node, anc = np.concatenate(self.nodes), np.concatenate(self.ancestors)
            p, base = np.array(self.shares, np.int64).T
            names, number = np.unique(np.array(self.sources, object), return_inverse=True)
            terms = np.array(self.rows, np.int64)[node]
            for one, other in ((node, anc), (anc, node)):
                value, pair = _both(other, one, p, base), number[one] * len(names) + number[other]
                found, at = np.unique(pair, return_inverse=True)
                # In two halves, as no half times the terms of a step leaves 64 bits.
                high, low = (np.zeros(len(found), np.int64) for _ in range(2))
                np.add.at(high, at, (value >> 31) * terms)
                np.add.at(low, at, (value & 0x7FFFFFFF) * terms)
                rows += [
                    (self.lang, names[x // len(names)], names[x % len(names)], Decimal((h << 31) + w))
                    for x, h, w in zip(found.tolist(), high.tolist(), low.tolist())
                ]
        self._clear()
        if not rows:
            return None
        types = (pa.string(), pa.string(), pa.string(), pa.decimal128(38, 0))
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows), types)], names=["lang", "source", "item", "value"]
        )


def pair_corrections(rows: DataFrame, audit: Audit) -> DataFrame:
    """(lang, source, item, value): what terms of both sources change, by trees over sorted rows.

    ``rows`` has lang, items of (source, p, base) and terms, the number of terms with them.
    """
    most = audit.combinations

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _Tree(most)
        for batch in batches:
            for lang, items, terms in zip(batch["lang"].to_pylist(), batch["items"], batch["terms"].to_pylist()):
                # Sums of a step stay below 2**62 with fewer than 2**31 terms.
                if lang != tree.lang or tree.n_combinations >= most or tree.n_terms + terms >= 1 << 31:
                    if (out := tree.corrections()) is not None:
                        yield out
                    tree.lang = lang
                tree.insert([tuple(x.values()) for x in items.as_py()], terms)
        if (out := tree.corrections()) is not None:
            yield out

    ordered = rows.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    return ordered.select("lang", "items", "terms").mapInArrow(grow, _PAIRS)


def pair_divergence(kept: DataFrame, groups: DataFrame, small: bool, audit: Audit) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, in both orders."""
    shares = groups.groupBy("lang").agg(
        F.first("v").alias("v"),
        F.map_from_entries(F.collect_list(F.struct("source", F.struct("n", "base")))).alias("own"),
    )
    terms = _with_lang(kept.where("term is not null").select("lang", "items"), shares, small)

    def item(x: Column) -> Column:
        own = F.element_at("own", x["source"])
        whole = (F.lit(audit.unit).cast("decimal(10,0)") * (x["count"] + 1).cast("decimal(19,0)"))
        p = 1 + F.call_function("div", whole, (own["n"] + F.col("v")).cast("decimal(19,0)"))
        return F.struct(x["source"].alias("source"), p.alias("p"), own["base"].alias("base"))

    rows = terms.select("lang", F.transform("items", item).alias("items")).groupBy("lang", "items")
    rows = stored(rows.agg(F.count("*").alias("terms")), "term-rows")
    both = pair_corrections(rows, audit)

    # Terms of one source, by distinct shares; sums over them come before any shuffle.
    single = rows.select("lang", "terms", F.inline("items")).groupBy("lang", "source", "p", "base").agg(F.sum("terms").alias("terms"))
    others = groups.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base"))
    met = _with_lang(single, others, small).where("source <> other")
    value = lambda a, b, p, q: (F.col("terms").cast("decimal(19,0)") * (_gap(a, b) - _gap(p, q)).cast("decimal(19,0)")).cast("decimal(38,0)")
    one = met.select("lang", F.inline(F.array(
        F.struct("source", F.col("other").alias("item"), value("p", "other_base", "base", "other_base").alias("value")),
        F.struct(F.col("other").alias("source"), F.col("source").alias("item"), value("other_base", "p", "other_base", "base").alias("value")),
    )))
    # Terms of neither.
    none = _with_lang(groups, others, small).where("source <> other").select(
        "lang", "source", F.col("other").alias("item"),
        F.coalesce(F.col("v").cast("decimal(19,0)") * _gap("base", "other_base").cast("decimal(19,0)"), F.lit(0)).cast("decimal(38,0)").alias("value"),
    )
    summed = none.unionAll(one).unionAll(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return summed.withColumn("value", F.col("value").cast("long"))


def term_divergence(kept: DataFrame, groups: DataFrame, small: bool, audit: Audit) -> DataFrame:
    """(lang, source, item, value) of the terms that are likelier in a source than in its language."""
    terms = kept.where("term is not null").select("lang", F.col("term").alias("item"), "total", F.inline("items"))
    known = groups.select("lang", "source", "n", "v", "n_lang")
    rows = terms.join(F.broadcast(known) if small else known, ["lang", "source"])
    rows = rows.withColumns({"p": _share("count", "n", audit), "q": _share("total", "n_lang", audit)})
    return rows.where("count > 0 and p > q").select("lang", "source", "item", _gap("p", "q").alias("value"))


def audit_sources(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, source, part, item, value, rank) for ``docs`` (text, lang, source).

    Part ``pair`` has for every source its divergence from each other source of the
    language, part ``term`` its terms that most exceed the language's share.

    Null lang, source and text are empty strings; a group whose rows hold no term is a
    group, and without a kept term all divergences of a language are 0. Every row is a
    document, also a repeated one. Equal values rank by the item's UTF-8 bytes. An empty
    table gives an empty one; ids and other columns take no part. A sum beyond 64 bits is
    an error.
    """
    kept = stored(kept_terms(docs, audit), "kept-terms")
    groups = stored(groups_of(kept, audit), "groups")
    small = is_small(groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    pairs = pair_divergence(kept, groups, small, audit).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank")
    )
    # The limit on ranks is applied in every task before the shuffle, so no group is too large.
    terms = term_divergence(kept, groups, small, audit).withColumn("rank", rank).where(F.col("rank") <= audit.term_ranks)
    return pairs.unionAll(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
