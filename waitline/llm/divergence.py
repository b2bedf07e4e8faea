"""How far the sources of a language diverge from each other, and by which terms.

Each task folds whole documents into stripes: for a term of a language the number of documents
that have it, and its occurrences by source. Stripes are hashed in memory, spilled when they
have ``MOST_ENTRIES`` entries, and merged by key in sorted order, so that a term that every
document has is one row per spill, never one per document. The merged stripes of the kept terms
go once more to tasks by term, each behind a row with the totals of the language; a task adds up
the divergences of all pairs of sources over its terms and holds the strongest terms of each.

All arithmetic is in whole numbers. A probability is ``1 + floor(SCALE * (count + 1) / (N + V))``
and a divergence ``floor((p - q)^2 / q)``, ``N`` being all occurrences and ``V`` the kept terms.

Null languages, sources and texts are empty ones. Every row is a document, repeated rows too.
Texts of any length are folded piece by piece. Ties are ordered by the bytes of the item. A source
without terms, or a language without kept terms, has its pairs all the same. An empty table gives
no rows, other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitline.llm.batches import slices
from waitline.llm.staging import stage

#: Fixed values of the contract.
LEAST_DOCS = 3
SCALE = 1_000_000_000
MOST_TERMS = 200
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A byte of a term, lower-cased, or a space. Bytes from 128 on are parts of other letters.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()
PIECE = 4 << 20
MOST_ENTRIES = 400_000
ROWS_OUT = 20_000
CELLS = 1 << 20
MOST_HELD = 1 << 22
TERMS_PER_TASK = 1 << 13

STRIPE = "lang string, term string, n_docs long, sources array<string>, counts array<long>"
FOUND = "lang string, source string, part string, item string, value long"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, long texts in pieces cut between terms."""
    clean = text.translate(TERM_BYTES)
    start = 0
    while start < len(clean):
        end = clean.find(b" ", start + PIECE)
        end = len(clean) if end < 0 else end
        yield clean[start:end].split()
        start = end


class Folded:
    """The stripes of the documents that a task has seen since the last spill."""

    def __init__(self):
        self.n_docs: dict[str, Counter] = defaultdict(Counter)
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.entries = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, seen = self.counts[lang, source], set()
        before = len(counts)
        for terms in terms_of(text):
            counts.update(terms)
            seen.update(terms)
        self.n_docs[lang].update(seen)
        self.entries += len(counts) - before

    def spilled(self) -> Iterator[pa.RecordBatch]:
        for lang, n_docs in self.n_docs.items():
            row_of = {term: row for row, term in enumerate(n_docs)}
            sources = [source for of, source in self.counts if of == lang]
            each = [self.counts[lang, source] for source in sources]
            rows = np.fromiter((row_of[t] for c in each for t in c), np.int64)
            order = np.argsort(rows, kind="stable")
            codes = np.repeat(np.arange(len(each)), [len(c) for c in each])[order]
            counts = np.fromiter((n for c in each for n in c.values()), np.int64)[order]
            ends = np.cumsum(np.bincount(rows, minlength=len(row_of)))
            yield from stripe_batches(
                pa.array([lang] * len(row_of), pa.string()),
                pa.array(list(row_of), pa.binary()).cast(pa.string()),
                np.fromiter(n_docs.values(), np.int64),
                ends,
                pa.array(sources, pa.string()).take(pa.array(codes)),
                counts,
            )


def stripe_batches(
    lang: pa.Array, term: pa.Array, n_docs: np.ndarray, ends: np.ndarray,
    sources: pa.Array, counts: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Rows of stripes, of which row n has the entries up to ``ends[n]``."""
    bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
    columns = [
        lang,
        term,
        pa.array(n_docs),
        pa.ListArray.from_arrays(bounds, sources),
        pa.ListArray.from_arrays(bounds, pa.array(counts)),
    ]
    whole = pa.RecordBatch.from_arrays(columns, ["lang", "term", "n_docs", "sources", "counts"])
    for start in range(0, whole.num_rows, ROWS_OUT):
        yield whole.slice(start, ROWS_OUT)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    folded = Folded()
    for part in slices(batches, "text"):
        texts = part.column("text").cast(pa.binary())
        for lang, source, text in zip(
            part.column("lang").to_pylist(), part.column("source").to_pylist(), texts, strict=True
        ):
            folded.add(lang, source, text.as_py())
            if folded.entries > MOST_ENTRIES:
                yield from folded.spilled()
                folded = Folded()
    yield from folded.spilled()


def _one_row_per_key(rows: pa.Table) -> pa.RecordBatch:
    """Stripes in order of their keys, those of one key added up."""
    rows = rows.combine_chunks()
    lang, term = (rows.column(c).combine_chunks() for c in ("lang", "term"))
    new = np.ones(rows.num_rows, bool)
    for key in (lang, term):
        other = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = other if key is lang else new[1:] | other
    starts = np.flatnonzero(new)
    key_of = np.cumsum(new) - 1
    lists = rows.column("sources").combine_chunks()
    sources = lists.flatten().dictionary_encode()
    entries = pa.table(
        {
            "key": key_of[pc.list_parent_indices(lists).to_numpy()],
            "code": sources.indices,
            "n": rows.column("counts").combine_chunks().flatten(),
        }
    )
    added = entries.group_by(["key", "code"]).aggregate([("n", "sum")]).sort_by("key")
    ends = np.cumsum(np.bincount(added["key"].to_numpy(), minlength=len(starts)))
    bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
    columns = [
        lang.take(pa.array(starts)),
        term.take(pa.array(starts)),
        pa.array(np.add.reduceat(rows.column("n_docs").to_numpy(), starts)),
        pa.ListArray.from_arrays(
            bounds, sources.dictionary.take(added["code"].combine_chunks())
        ),
        pa.ListArray.from_arrays(bounds, added["n_sum"].combine_chunks()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "term", "n_docs", "sources", "counts"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kept stripes, from stripes sorted by key; the last key waits for the next batch."""

    def kept(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.filter(pc.greater_equal(rows.column("n_docs"), LEAST_DOCS))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            rows = _one_row_per_key(pa.Table.from_batches([*held, batch]))
            yield kept(rows.slice(0, rows.num_rows - 1))
            held = [rows.slice(rows.num_rows - 1)]
    for rows in held:
        yield kept(rows)


def kept_stripes(docs: DataFrame) -> DataFrame:
    """``lang, term, n_docs, sources, counts`` of every term that enough documents have."""
    spilled = docs.mapInArrow(_fold, STRIPE)
    by_key = spilled.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return by_key.mapInArrow(_merge, STRIPE)


def probability(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``1 + floor(SCALE * (counts + 1) / total)`` in three steps, none of which overflows."""
    whole, left = np.divmod(counts + 1, total)
    for _ in range(3):
        more, left = np.divmod(left * 1000, total)
        whole = whole * 1000 + more
    return 1 + whole


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Language:
    """What a task finds in its terms of one language."""

    def __init__(self, header: dict):
        self.lang = header["lang"]
        self.sources = pa.array(header["sources"], pa.string())
        totals = np.array(header["counts"], np.int64)
        self.total, self.whole = totals + header["n_docs"], totals.sum() + header["n_docs"]
        n = len(totals)
        self.holds = n * n <= MOST_HELD
        self.pairs = np.zeros((n, n) if self.holds else (1, 1), np.int64)
        none = np.zeros(0, np.int64)
        self.best = (none, none, pa.array([], pa.string()))

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // len(self.sources))
        for start in range(0, rows.num_rows, step):
            yield from self._add(rows.slice(start, step))

    def _add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = rows.column("sources")
        codes = pc.index_in(lists.flatten(), value_set=self.sources).to_numpy()
        counts = np.zeros((rows.num_rows, len(self.sources)), np.int64)
        counts[pc.list_parent_indices(lists).to_numpy(), codes] = (
            rows.column("counts").flatten().to_numpy()
        )
        p = probability(counts, self.total)
        for other in range(len(self.sources)):
            q = p[:, other, None]
            sums = divergence(p, q).sum(0)
            if self.holds:
                self.pairs[:, other] += sums
            else:
                yield from self._pairs(other, sums)
        q = probability(counts.sum(1), self.whole)[:, None]
        row, source = np.nonzero((counts > 0) & (p > q))
        value = divergence(p, q)[row, source]
        self._keep_best(source, value, rows.column("term").take(pa.array(row)))

    def _keep_best(self, source: np.ndarray, value: np.ndarray, term: pa.Array) -> None:
        """Terms arrive in order of their bytes, so of equal values the earlier is first."""
        source, value = (np.concatenate(x) for x in zip(self.best[:2], (source, value), strict=True))
        term = pa.concat_arrays([self.best[2], term])
        order = np.lexsort((np.arange(len(source)), -value, source))
        of = source[order]
        first = np.searchsorted(of, of)
        order = np.sort(order[np.arange(len(of)) - first < MOST_TERMS])
        self.best = (source[order], value[order], term.take(pa.array(order)))

    def _pairs(self, other: int, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        of = np.flatnonzero(np.arange(len(sums)) != other)
        yield self._rows("pair", of, self.sources.take(pa.array(np.full(len(of), other))), sums[of])

    def _rows(
        self, part: str, of: np.ndarray, item: pa.Array, value: np.ndarray
    ) -> pa.RecordBatch:
        n = len(of)
        columns = [
            pa.array([self.lang] * n, pa.string()),
            self.sources.take(pa.array(of)),
            pa.array([part] * n, pa.string()),
            item,
            pa.array(value, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "part", "item", "value"])

    def found(self) -> Iterator[pa.RecordBatch]:
        if self.holds:
            for other in range(len(self.sources)):
                yield from self._pairs(other, self.pairs[:, other])
        yield self._rows("term", self.best[0], self.best[2], self.best[1])


def _diverge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Divergences from stripes, the first of each language being the totals by source."""
    current = None
    for batch in batches:
        heads = np.flatnonzero(batch.column("term").is_null().to_numpy(zero_copy_only=False))
        cuts = [0, *heads, batch.num_rows]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            if start == stop:
                continue
            rows = batch.slice(start, stop - start)
            if start in heads:
                if current:
                    yield from current.found()
                current = Language(rows.slice(0, 1).to_pylist()[0])
                rows = rows.slice(1)
            yield from current.add(rows)
    if current:
        yield from current.found()


def partial_divergences(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value`` of portions of each language's kept terms.

    A portion gives a row per pair of sources. A language has as many as its kept terms need, so
    the rows do not grow with the number of tasks.
    """
    kept = stage(kept_stripes(docs))
    groups = docs.select("lang", "source").distinct()
    entries = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("entry"))
    totals = entries.groupBy("lang", F.col("entry.sources").alias("source")).agg(
        F.sum("entry.counts").alias("total")
    )
    n_terms = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    by_source = (
        groups.join(totals, ["lang", "source"], "left")
        .groupBy("lang")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))
            ).alias("groups")
        )
        .join(n_terms, "lang", "left")
    )
    portions = F.ceil(F.col("n_terms") / TERMS_PER_TASK).cast("int")
    last = F.coalesce(portions, F.lit(1)) - 1
    headers = by_source.select(
        "lang",
        F.lit(None).cast("string").alias("term"),
        F.coalesce("n_terms", F.lit(0)).alias("n_docs"),
        F.col("groups.source").alias("sources"),
        F.col("groups.total").alias("counts"),
        F.explode(F.sequence(F.lit(0), last)).alias("portion"),
    )
    dealt = (
        kept.join(F.broadcast(n_terms), "lang")
        .withColumn("portion", F.pmod(F.xxhash64("term"), portions).cast("int"))
        .drop("n_terms")
        .unionByName(headers)
        .repartition("lang", "portion")
        .sortWithinPartitions("lang", "portion", F.col("term").asc_nulls_first())
    )
    return dealt.drop("portion").mapInArrow(_diverge, FOUND)


def audited(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``; see the module."""
    docs = docs.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )
    found = partial_divergences(docs)
    strongest = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (
        found.groupBy("lang", "source", "part", "item")
        .agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(strongest))
        .filter((F.col("part") == "pair") | (F.col("rank") <= MOST_TERMS))
    )
