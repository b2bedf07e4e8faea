"""Token counts of documents from counts of distinct pre-tokens."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitline.llm.batches import slices
from waitline.llm.staging import stage

#: At most so many frequent pre-tokens are known to every task (about 12 bytes each).
KNOWN = 200_000
#: Distinct pre-tokens that a task gathers before it passes them on.
GATHERED = 300_000
#: Characters whose classes are the same in every version of Unicode that is in use.
AGREED = r"\x00-\u0557\u2000-\u206f\u20a0-\u20bf\u2100-\u214f\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fa5\uac00-\ud7a3"


class Cutter:
    """Cuts a text into pre-tokens: special tokens first, the rest by the tokenizer's pattern.

    No merge crosses a pre-token, and a pre-token alone is cut no further, so the tokens of a
    text are those of its pre-tokens.
    """

    def __init__(self, model_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(model_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile(f"({'|'.join(map(regex.escape, longest_first))})").split
        self.pattern = regex.compile(public_tokenizers.PATTERN).findall
        self.odd = regex.compile(f"[^{AGREED}]").search

    def find(self, text: str) -> list[str]:
        """By the pattern; by the library itself if its Unicode tables may be others than here."""
        if not self.odd(text):
            return self.pattern(text)
        cuts = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[start:stop] for _, (start, stop) in cuts]

    def cut(self, text: str) -> list[str]:
        if not any(word in text for word in self.special):
            return self.find(text)
        found = []
        for number, part in enumerate(self.split(text)):
            found += [part] if number % 2 else self.find(part)
        return found

    def tokens(self, pieces: list[str]) -> list[int]:
        return [len(x.ids) for x in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _cutter(model_path: str) -> Cutter:
    return Cutter(model_path)


def _times(docs: DataFrame, model_path: str) -> DataFrame:
    """``piece, times``: how often each task's documents have each pre-token."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["piece", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = _cutter(model_path).cut, Counter()
        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                counts.update(cut(text or ""))
                if len(counts) >= GATHERED:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    return docs.select("text").mapInArrow(run, "piece string, times long")


def piece_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """``piece, times, tokens`` of every distinct pre-token; each is tokenized once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _cutter(model_path).tokens(batch.column("piece").to_pylist())
            columns = [*batch.columns, pa.array(counts, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "times", "tokens"])

    totals = _times(docs, model_path).groupBy("piece").agg(F.sum("times").alias("times"))
    return stage(totals.mapInArrow(run, "piece string, times long, tokens int"))


def _known(pieces: DataFrame) -> dict[str, int]:
    """Tokens of the most frequent pre-tokens, KNOWN at most; chosen by classes of frequency."""
    of_class = F.floor(F.log2("times") * 8).alias("class")
    by_class = pieces.groupBy(of_class).count().orderBy(F.desc("class")).collect()
    least, total = None, 0
    for row in by_class:
        total += row["count"]
        if total > KNOWN:
            break
        least = row["class"]
    if least is None:
        return {}
    return dict(pieces.filter(of_class >= least).select("piece", "tokens").collect())


def counted(docs: DataFrame, model_path: str, keep: list[str]) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``n_bytes`` and ``n_tokens`` of each document.

    Tokens as the tokenizer counts them, without begin or end; special strings inside a text are
    its special tokens. A null or empty text has 0 bytes and 0 tokens; every row counts for
    itself, also if another is equal.

    Pre-tokens are counted over all documents and tokenized once each. Documents add up the
    frequent ones, a table of bounded size that every task holds, and join the rare ones, whose
    rows are few per document. No ids are kept. ``model_path`` is read on every executor.
    """
    pieces = piece_tokens(docs, model_path)
    known = docs.sparkSession.sparkContext.broadcast(_known(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, tokens = _cutter(model_path).cut, known.value
        for batch in slices(batches, "text"):
            sums, sizes, rare = [], [], []
            for text in batch.column("text").to_pylist():
                found = cut(text or "")
                sums.append(sum(tokens.get(piece, 0) for piece in found))
                rest = Counter(piece for piece in found if piece not in tokens)
                rare.append([{"piece": p, "times": n} for p, n in rest.items()])
                sizes.append(len((text or "").encode("utf-8", "surrogatepass")))
            kind = pa.list_(pa.struct([("piece", pa.string()), ("times", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(rare, kind),
                ],
                ["doc", "n_bytes", "known", "rare"],
            )

    rows = docs.select(F.struct(*keep).alias("doc"), "text")
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, n_bytes long, known long, rare array<struct<piece: string, times: long>>"
    texts = stage(
        rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    )
    others = (
        texts.select("row", F.inline("rare"))
        .join(pieces.select("piece", "tokens"), "piece")
        .groupBy(F.col("row").alias("of"))
        .agg(F.sum(F.col("tokens") * F.col("times")).alias("others"))
    )
    total = F.col("known") + F.coalesce("others", F.lit(0))
    return texts.join(others, F.col("row") == F.col("of"), "left").select(
        "doc", "n_bytes", total.alias("n_tokens")
    )
