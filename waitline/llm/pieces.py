"""SentencePiece encoding of merge type (BPE with byte fallback) by backtracking, and decoding."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitline.llm.batches import slices

BLANK = "▁"
#: Chunks and pairs that a worker keeps (about 250 and 100 bytes each).
KEPT_CHUNKS = 250_000
KEPT_PAIRS = 250_000
#: Pieces of blanks alone score below all others.
RUN_SCORE = -1e8
LONGEST = 64


class PieceModel:
    """Pieces, scores and the encoder of one model.

    A text is cut where no merge can cross: before blanks, around characters that are no piece,
    and before characters that follow a letter in no piece. A chunk is encoded by backtracking:
    the longest piece at a place is tried first, then its shorter prefixes; a piece may follow
    another only if merging the two again gives the same two; places from which no way led on
    are marked in a bit field. Pieces that are runs of blanks have one score, the lowest, and
    merge last, from the left.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        every = range(len(self.pieces))
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in every if model.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        plain = [
            i
            for i in every
            if i not in self.byte_of
            and not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        self.made_of: dict[str, tuple[str, str]] = {}
        self.runs = {len(p) for p in self.ids if not p.strip(BLANK)}
        self._check()
        single = {p for p in self.ids if len(p) == 1} - {BLANK}
        after_letter = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        starters = "".join(c for c in ".,;:!?)" if c in single - after_letter)
        every_char, alpha = (
            "".join(map(re.escape, sorted(chars)))
            for chars in (single, filter(str.isalpha, single))
        )
        word = f"[{alpha}]++(?=[ {BLANK}{re.escape(starters)}]|\\Z)"
        self.chunks = re.compile(
            f"[ {BLANK}]+(?:{word}|[{every_char}]*+)|{word}|[{every_char}]++|[^ {BLANK}]"
        )
        self.automaton = ahocorasick.Automaton()
        stable = [p for p in self.ids if p == BLANK or (p.strip(BLANK) and self.merge(p) == [p])]
        for piece in stable:
            self.automaton.add_word(piece, self.ids[piece] * LONGEST + len(piece))
        self.automaton.make_automaton()
        self.words = {p: self.ids[p] * LONGEST + len(p) for p in stable}
        self.shorter = {piece: self._prefix(p) for p, piece in self.words.items()}
        self.growth = [{self.ids[p]: self._grown(p, side) for p in stable} for side in (0, 1)]
        self.pairs: dict[int, bool] = {}
        self.codes: dict[str, int] = {}
        self.starts, self.flat = array("q", [0]), array("i")

    def _check(self) -> None:
        """The properties on which the cuts and the order of merges rest."""
        across = any(BLANK in p.lstrip(BLANK) for p in self.ids)
        before = any(p[:2] == BLANK * 2 and p.strip(BLANK) for p in self.ids)
        runs_last = all(self.scores[BLANK * n] < RUN_SCORE for n in self.runs if n > 1)
        others = [s for p, s in self.scores.items() if p.strip(BLANK) and len(p) > 1]
        if across or before or not runs_last or len(set(others)) < len(others):
            raise ValueError("the model's merges cross words, or their order is not by score")
        if max(map(len, self.ids)) >= LONGEST:
            raise ValueError(f"pieces must be shorter than {LONGEST} characters")

    def _prefix(self, piece: str) -> int:
        """The longest shorter piece that a piece begins with, or 0."""
        for length in range(len(piece) - 1, 0, -1):
            if found := self.words.get(piece[:length]):
                return found
        return 0

    def merge(self, text: str) -> list[str]:
        """Merge a short text step by step: the best score first, the leftmost of equals."""
        parts, worst = list(text), float("-inf")
        while len(parts) > 1:
            pairs = zip(parts, parts[1:], strict=False)
            scores = [self.scores.get(a + b, worst) for a, b in pairs]
            best = max(scores)
            if best == worst:
                break
            at = scores.index(best)
            if len(parts) == 2:
                self.made_of[text] = parts[0], parts[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _grown(self, piece: str, side: int) -> list[tuple[str, float]]:
        """What stands at an end of a piece (0 the left) while it is merged from characters, and
        the score of the merge that ends each; the parts must score above what they make."""
        steps, ends = [], float("-inf")
        while True:
            steps.append((piece, ends))
            if len(piece) == 1:
                return steps[::-1]
            ends = self.scores[piece]
            if any(len(part) > 1 and self.scores[part] < ends for part in self.made_of[piece]):
                raise ValueError("a piece scores above one of its parts")
            piece = self.made_of[piece][side]

    def follows(self, one: int, other: int) -> bool:
        """Whether two pieces, merged again from their characters, come out as the same two.

        As parts score above what they make, only merges at the border matter: the two would be
        lost if what stands on both sides of it merged before either is merged into more.
        """
        key = one // LONGEST << 32 | other // LONGEST
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._remerge(one // LONGEST, other // LONGEST)
        return known

    def _remerge(self, one: int, other: int) -> bool:
        left, right = self.growth[1][one], self.growth[0][other]
        i = j = 0
        while True:
            (a, ends_a), (b, ends_b) = left[i], right[j]
            across = self.scores.get(a + b)
            if across is not None and across > ends_a and across >= ends_b:
                return False
            if i + 1 == len(left) and j + 1 == len(right):
                return True
            if j + 1 == len(right) or (i + 1 < len(left) and ends_a >= ends_b):
                i += 1
            else:
                j += 1

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose characters all are pieces."""
        longest = [0] * len(text)
        for end, piece in self.automaton.iter(text):
            longest[end - piece % LONGEST + 1] = piece  # a later end is a longer piece
        pairs, shorter, length = self.pairs, self.shorter, len(text)
        open_places = (1 << (length + 1)) - 1
        found: list[int] = []
        at, piece, last = 0, longest[0], 0
        while True:
            end = at + piece % LONGEST
            if open_places >> end & 1:
                fits = not last or pairs.get(last // LONGEST << 32 | piece // LONGEST)
                if fits or (fits is None and self.follows(last, piece)):
                    found.append(piece)
                    if end == length:
                        return [p // LONGEST for p in found]
                    at, last, piece = end, piece, longest[end]
                    continue
            piece = shorter[piece]
            while not piece:
                open_places &= ~(1 << at)
                dropped = found.pop()
                at -= dropped % LONGEST
                last = found[-1] if found else 0
                piece = shorter[dropped]

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of blanks followed by letters, or of a character that is no piece."""
        chunk = chunk.replace(" ", BLANK)
        letters = chunk.lstrip(BLANK)
        blanks = len(chunk) - len(letters)
        if not blanks and len(letters) == 1 and letters not in self.ids:
            return [self.id_of_byte[b] for b in letters.encode()]
        if not letters:
            return self.blanks(blanks)
        found = self.backtrack(BLANK + letters if blanks else letters)
        if blanks < 2:
            return found
        if found[0] == self.ids[BLANK]:
            return self.blanks(blanks) + found[1:]
        return self.blanks(blanks - 1) + found

    def blanks(self, count: int) -> list[int]:
        """Runs merge from the left: the first grows as long as the next length is a piece."""
        found: list[int] = []
        for _ in range(count):
            found.append(1)
            while len(found) > 1 and found[-2] + found[-1] in self.runs:
                found[-2:] = [found[-2] + found[-1]]
        return [self.ids[BLANK * n] for n in found]

    def code(self, chunk: str) -> int:
        """The number under which the ids of a chunk are kept."""
        self.flat.extend(self.encode_chunk(chunk))
        self.starts.append(len(self.flat))
        self.codes[chunk] = len(self.starts) - 2
        return len(self.starts) - 2

    def encode_batch(self, texts: list[str]) -> pa.Array:
        """Ids of each text as one list array."""
        if len(self.codes) >= KEPT_CHUNKS:
            self.codes, self.starts, self.flat = {}, array("q", [0]), array("i")
        known, cut = self.codes, self.chunks.findall
        codes: list[int] = []
        ends = [0]
        for text in texts:
            for chunk in cut(" " + text) if text else ():
                code = known.get(chunk)
                codes.append(self.code(chunk) if code is None else code)
            ends.append(len(codes))
        starts = np.frombuffer(self.starts, np.int64)
        chosen = np.array(codes, np.int64)
        sizes = starts[chosen + 1] - starts[chosen]
        before = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(before[-1]) + np.repeat(starts[chosen] - before[:-1], sizes)
        ids = np.frombuffer(self.flat, np.int32)[place] if len(place) else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(before[ends], pa.int32()), pa.array(ids))

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].as_py()

    @property
    def spelled(self) -> pa.Array:
        """The bytes that each id stands for, with spaces for blanks."""
        spelled = [
            bytes([self.byte_of[i]]) if i in self.byte_of else piece.replace(BLANK, " ").encode()
            for i, piece in enumerate(self.pieces)
        ]
        return pa.array(spelled, pa.binary())

    def decode_batch(self, ids: pa.ListArray, spelled: pa.Array) -> pa.Array:
        """Texts of lists of ids: bytes become characters, the blank in front goes."""
        joined = pc.binary_join(
            pa.ListArray.from_arrays(ids.offsets, spelled.take(ids.values)), b""
        )
        texts = [text.decode(errors="replace") for text in joined.to_pylist()]
        heads = (row[0].as_py() if len(row) else 0 for row in ids)
        return pa.array(
            [
                text[1:] if self.pieces[head].startswith(BLANK) else text
                for text, head in zip(texts, heads, strict=True)
            ],
            pa.string(),
        )

    def decode(self, ids: list[int]) -> str:
        return self.decode_batch(pa.array([ids], pa.list_(pa.int32())), self.spelled)[0].as_py()


@lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    return PieceModel(path)


def encoded(docs: DataFrame, model_path: str, keep: list[str]) -> DataFrame:
    """``doc`` (a struct of the columns ``keep``) and ``ids``, the ids of the whole text.

    No begin or end ids. A null or empty text has none. One pass without a shuffle; a worker
    holds a few megabytes of text, and bounded tables of chunks and pairs it has seen.
    ``model_path`` is read on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in slices(batches, "text"):
            ids = model.encode_batch(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), ids], ["doc", "ids"])

    rows = docs.select(F.struct(*keep).alias("doc"), "text")
    schema = T.StructType([rows.schema["doc"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """The rows of ``encoded`` with ``decoded``, the text of the ids; of no ids the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        spelled = model.spelled
        for batch in slices(batches, "ids"):
            ids = batch.column("ids").fill_null([])
            dense = pa.array(ids.value_lengths().to_numpy(zero_copy_only=False))
            offsets = pa.array(np.concatenate([[0], np.cumsum(dense)]), pa.int32())
            own = pa.ListArray.from_arrays(offsets, ids.flatten())
            texts = model.decode_batch(own, spelled)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, texts], [*batch.schema.names, "decoded"]
            )

    schema = T.StructType([*rows.schema, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, schema)
