"""SentencePiece encoding and decoding by a shared-prefix trie.

Texts are normalised as the model asks (a space becomes the mark, one mark
goes before the text) and cut into marked words. The distinct words of a
batch (about BATCH_BYTES of whole texts) are sorted and traversed
depth-first as a trie: the forward scores of a prefix are computed once, when
the traversal enters it, and serve every word below it.

For a unigram model the forward score of a prefix is the best sum of piece
scores over its segmentations (Viterbi). For a BPE model that maximum is not
what SentencePiece returns: its result is the end of a sequence of merges. A
prefix then carries the last piece of its merge result instead. Of the pieces
that end a prefix exactly one is: the one that would not have merged otherwise
with the piece before it. This needs the same forward pass and gives the ids
of the SentencePiece library. README says so under its name.

Characters without a piece become byte pieces, or the unknown piece where the
model has none. Decoding joins pieces, reads byte pieces as UTF-8 and drops
the mark before the text; for a model with byte pieces it gives back the text
that was encoded, unless that has the mark itself as a character.

Defined cases: a null text has null ids; an empty text has none; texts of any
length are whole; repeated rows are encoded alike; columns other than id and
text are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.text import table

MARK = "▁"
MODEL_FILE = "piece_bpe_32k.model"
MAX_PAIRS = 250_000         # pairs of pieces whose merging a worker remembers
ROWS = 1_000                # rows of a result batch
BATCH_BYTES = 16_000_000    # texts whose distinct words are encoded together (whole rows)


@dataclass
class Pieces:
    """A vocabulary: pieces and scores by id, ``kind`` bpe or unigram, byte
    pieces by value, the id of the unknown piece, ids that stand for no text."""

    pieces: list[str]
    scores: list[float]
    kind: str
    byte_ids: dict[int, int] = field(default_factory=dict)
    unknown: int = 0
    silent: frozenset = frozenset()

    def __post_init__(self) -> None:
        special = set(self.byte_ids.values()) | self.silent | {self.unknown}
        self.ids = {p: k for k, p in enumerate(self.pieces) if k not in special}
        # sizes of the pieces with the same last three characters (or fewer), longest first
        sizes: dict[str, set[int]] = {}
        for p in self.ids:
            sizes.setdefault(p[-3:], set()).add(len(p))
        self.sizes = {end: tuple(sorted(x, reverse=True)) for end, x in sizes.items()}
        # characters that no longer piece holds end a word on either side
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        joins_mark = any(MARK in p.lstrip(MARK) for p in self.ids)
        solid = "".join(sorted(re.escape(c) for c in inside if c != MARK))
        self.cut = None if joins_mark else re.compile(f"{MARK}*[{solid}]+|{MARK}+|[^{MARK}{solid}]") if solid \
            else re.compile(".", re.S)
        self.fits: dict[tuple[int, int], bool] = {}
        self.tails: dict[str, tuple[int, ...]] = {}

    # -- byte-pair merging -------------------------------------------------

    def merged(self, text: str) -> list[int]:
        """Ids of ``text`` by merging the best-scored pair, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                piece = self.ids.get(parts[k] + parts[k + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids.get(p, -1) for p in parts]

    def pair_stands(self, a: int, b: int) -> bool:
        """Whether two pieces, each the result of merging its own text, stay
        two when their texts are merged together."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > MAX_PAIRS:
                self.fits.clear()
            known = self.fits[a, b] = self.merged(self.pieces[a] + self.pieces[b]) == [a, b]
        return known

    def whole(self, piece: int) -> bool:
        """Whether merging a piece's text gives the piece."""
        known = self.fits.get((piece, -1))
        if known is None:
            known = self.fits[piece, -1] = self.merged(self.pieces[piece]) == [piece]
        return known

    # -- the trie ----------------------------------------------------------

    def ends(self, word: str, end: int) -> tuple[int, ...]:
        """Sizes, longest first, of the pieces that may end at ``end``."""
        if end < 3:
            return self.sizes.get(word[:end], ()) + (self.sizes.get(word[end - 1:end], ()) if end == 2 else ())
        tail = word[end - 3:end]
        known = self.tails.get(tail)
        if known is None:
            if len(self.tails) > MAX_PAIRS:
                self.tails.clear()
            known = self.tails[tail] = sum((self.sizes.get(tail[k:], ()) for k in range(3)), ())
        return known

    def last_piece(self, word: str, end: int, state: list) -> tuple[float, int]:
        """Forward score and last piece of ``word[:end]``; ``state`` holds
        those of all shorter prefixes. A piece of -1 is a character without one."""
        if self.kind == "bpe":
            ids, fits = self.ids, self.fits
            for size in self.ends(word, end):
                piece = ids.get(word[end - size:end]) if size <= end else None
                if piece is None:
                    continue
                stands = fits.get((piece, -1))
                if not (self.whole(piece) if stands is None else stands):
                    continue
                before = state[end - size][1]
                if before < 0:
                    return 0.0, piece
                stands = fits.get((before, piece))
                if self.pair_stands(before, piece) if stands is None else stands:
                    return 0.0, piece
            return 0.0, -1
        best, last = -float("inf"), -1
        ends = [word[end - tail:end] for tail in (1, 2, 3) if tail <= end]
        for size in sorted({size for x in ends for size in self.sizes.get(x, ()) if size <= end}):
            piece = self.ids.get(word[end - size:end])
            if piece is not None and state[end - size][0] + self.scores[piece] > best:
                best, last = state[end - size][0] + self.scores[piece], piece
        lowest = min(self.scores, default=0.0) - 10.0
        if last == -1 or state[end - 1][0] + lowest > best:
            return state[end - 1][0] + lowest, -1
        return best, last

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each word."""
        return dict(self.encoded_words(words))

    def encoded_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each word with its ids. The words are sorted, so that those with a
        common prefix follow each other; ``state`` is the path from the trie's
        root, cut back to the common prefix and extended along each word."""
        state, last = [(0.0, -2)], ""
        for word in sorted(words):
            same = 0
            for x, y in zip(last, word, strict=False):
                if x != y:
                    break
                same += 1
            del state[same + 1:]
            for end in range(same + 1, len(word) + 1):
                state.append(self.last_piece(word, end, state))
            last = word
            ids, end = [], len(word)
            while end:
                piece = state[end][1]
                if piece == -1:
                    ids.extend(reversed(self.unknown_ids(word[end - 1])))
                    end -= 1
                else:
                    ids.append(piece)
                    end -= len(self.pieces[piece])
            yield word, ids[::-1]

    def unknown_ids(self, character: str) -> list[int]:
        if self.byte_ids:
            return [self.byte_ids[x] for x in character.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def words(self, text: str) -> list[str]:
        """The marked words of a text: independent parts, in order."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return [marked] if self.cut is None else self.cut.findall(marked)

    # -- back to text ------------------------------------------------------

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join([self.surface[k] for k in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def stands_for(self, ids: np.ndarray, text: str) -> bool:
        """Whether ``decode`` of the ids gives the text (compared as bytes)."""
        surface = self.surface
        data = b"".join([surface[k] for k in ids.tolist()])
        data = data[1:] if data.startswith(b" ") else data
        return data == text.encode("utf-8", "surrogatepass") or data.decode("utf-8", "replace") == text

    @property
    def surface(self) -> list[bytes]:
        """UTF-8 bytes that each id stands for."""
        if "_surface" not in self.__dict__:
            out = [p.replace(MARK, " ").encode() for p in self.pieces]
            for value, k in self.byte_ids.items():
                out[k] = bytes([value])
            for k in self.silent:
                out[k] = b""
            if not self.byte_ids:
                out[self.unknown] = " ⁇ ".encode()
            self.__dict__["_surface"] = out
        return self.__dict__["_surface"]


def load(model: bytes, kind: str = "bpe") -> Pieces:
    """The vocabulary of a SentencePiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(k) for k in range(n)]
    byte_ids = {int(pieces[k][3:5], 16): k for k in range(n) if sp.is_byte(k)}
    return Pieces(pieces, [sp.get_score(k) for k in range(n)], kind, byte_ids, sp.unk_id(),
                  frozenset(k for k in range(n) if sp.is_control(k)))


_worker: dict = {}


def _of_worker(shared) -> Pieces:
    """The vocabulary, kept by the worker."""
    key = hash(shared.value)
    if _worker.get("key") != key:
        _worker.update(key=key, pieces=load(*shared.value))
    return _worker["pieces"]


def encode_texts(texts: Iterable[str | None], pieces: Pieces) -> Iterator[np.ndarray | None]:
    """Ids of each text. The words are numbered as they come, the distinct ones
    encoded once, in one traversal, and each text's ids picked by its numbers."""
    number: dict[str, int] = {}
    rows = [None if t is None else np.array([number.setdefault(w, len(number)) for w in pieces.words(t)], np.int32)
            for t in texts]
    flat, start, size = array("i"), np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    for word, ids in pieces.encoded_words(number):
        k = number[word]
        start[k], size[k] = len(flat), len(ids)
        flat.extend(ids)
    del number
    every = np.array(flat, np.int32)
    for row in rows:
        if row is None:
            yield None
        else:
            n = size[row]
            yield every[np.repeat(start[row] - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _lists(ids: list[np.ndarray | None]) -> pa.ListArray:
    size = np.array([0 if x is None else len(x) for x in ids], np.int64)
    flat = np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)])
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.array([*(x is None for x in ids), False], bool)),
                                    pa.array(flat, pa.int32()))


def encode(docs: DataFrame, model: bytes, text_col: str = "text", kind: str = "bpe") -> Column:
    """Column array<int>: the ids of each text. The model is a file of fixed size, broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((model, kind))

    def run(column: pa.Array) -> pa.Array:
        return _lists(list(encode_texts(column.to_pylist(), _of_worker(shared))))

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<int>").asNondeterministic()(F.col(text_col))


def decode(ids: DataFrame, model: bytes, ids_col: str = "ids", kind: str = "bpe") -> Column:
    """Column string: the text of each list of ids; null for null."""
    shared = ids.sparkSession.sparkContext.broadcast((model, kind))

    def run(column: pa.Array) -> pa.Array:
        pieces = _of_worker(shared)
        column = column.cast(pa.list_(pa.int32()))
        flat, off = np.asarray(column.flatten()), np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths().fill_null(0)))])
        known = np.asarray(column.is_valid())
        return pa.array([pieces.decode(flat[off[k]:off[k + 1]].tolist()) if known[k] else None for k in range(len(column))],
                        pa.string())

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "string").asNondeterministic()(F.col(ids_col))


def model_bytes(path: str | None = None) -> bytes:
    """A model file; by default the public one that is installed beside the library."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL_FILE)
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                     kind: str = "bpe", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ids, n_ids, same, *keep): the ids, their number, and whether decoding
    gives back the text. Ids go from the worker straight to the result; the
    texts don't travel back."""
    shared = docs.sparkSession.sparkContext.broadcast((model, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _of_worker(shared)
        parts, size = [], 0

        def done() -> Iterator[pa.RecordBatch]:
            found = encode_texts((t for part in parts for t in part.column(1).to_pylist()), pieces)
            for part in parts:
                ids = list(islice(found, part.num_rows))
                texts = part.column(1).to_pylist()
                same = [None if x is None else pieces.stands_for(x, t) for x, t in zip(ids, texts, strict=True)]
                n = [None if x is None else len(x) for x in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids), pa.array(n, pa.int64()),
                                                  pa.array(same, pa.bool_()), *part.columns[2:]],
                                                 names=["doc_id", "ids", "n_ids", "same", *keep])

        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                parts.append(batch.slice(lo, ROWS))
                size += parts[-1].nbytes
                if size > BATCH_BYTES:
                    yield from done()
                    parts, size = [], 0
        yield from done()
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *keep)
    kept = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, n_ids long, same boolean{kept}")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), model_bytes())
