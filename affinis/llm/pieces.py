"""SentencePiece encoding by streaming Viterbi, and decoding.

The best path through the lattice of pieces is found from left to right. Only the last boundaries within the longest
piece's reach can start a further piece, so only those stay open. A boundary that is out of reach and that no path uses
any more is dropped, and with it the ancestors that only it kept; as soon as all surviving paths run through one
boundary, the ids before it can no longer change and are committed. Every boundary is added and dropped once, so the
work is linear in the text whatever it holds.

A path's score is the sum of the model's own piece scores. Under a model of merges (BPE) two pieces may follow each other
only where merging the characters of both gives these two again. A sequence of such steps is what merging the whole
text gives, so exactly one path reaches each boundary, and the ids are those of the merges. Under a unigram model every
step is allowed, and the highest sum wins; ties go to the longer last piece.

A text is cut first where no piece of the vocabulary can span (such as before spaces and between letters and signs); what
stands between two cuts has the same ids in every text, and each worker keeps those it has seen. A character that no piece covers becomes byte pieces, and so does a
literal U+2581, so decoding returns every text exactly.

Nulls and edge cases: a null text is empty; an empty text has no ids; repeated rows are rows of their own; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import sliced, trim

MODEL = "piece_bpe_32k.model"
#: Chunks of text, and pairs of pieces, that each worker remembers; when full, it starts afresh.
KEPT, KEPT_PAIRS = 200_000, 400_000
#: Longest chunk that is remembered.
LONGEST = 48


def _chunks(pieces: Iterable[str]) -> Callable[[str], list[str]]:
    """Cuts a text where no piece can span: before spaces and between letters, digits and other characters, if pieces allow."""
    letter, digit = re.compile(r"[^\W\d_]").match, re.compile(r"\d").match
    odd: set[str] = set()  # letters that some piece joins to another kind of character count as that kind
    digits = joins = False
    for p in pieces:
        joins |= " " in p.lstrip(" ")
        digits |= len(p) > 1 and any(map(digit, p))
        odd.update(c for a, b in itertools.pairwise(p) for c, other in ((a, b), (b, a)) if letter(c) and other != " " and not letter(other))
    if joins:
        return lambda text: [text]
    if digits or len(odd) > 64:
        return re.compile(" *[^ ]+| +").findall
    own = re.escape("".join(sorted(odd)))
    return re.compile(rf" *[^\W\d_{own}]+|\d| *(?:[^\w ]|[_{own}])+| +").findall


class Vocabulary:
    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], byte_score: float, merges: bool = False):
        """pieces: text with plain spaces -> (id, score); byte_ids: the ids of the 256 byte pieces; merges: a BPE model."""
        self.pieces, self.byte_ids, self.byte_score, self.merges = pieces, byte_ids, byte_score, merges
        self.reach = max(map(len, pieces), default=1)
        self.texts = {i: p.encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.trie: dict = {}
        for p in pieces:
            node = self.trie
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = p
        self.chunks = _chunks(pieces)
        self.known: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    @classmethod
    def load(cls, file: str = MODEL, merges: bool = True) -> Vocabulary:
        import public_tokenizers as public
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=file if "/" in file else public.path(file))
        pieces, byte_ids = {}, [0] * 256
        for i in range(m.get_piece_size()):
            if m.is_byte(i):
                byte_ids[int(m.id_to_piece(i)[3:-1], 16)] = i
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                pieces[m.id_to_piece(i).replace("▁", " ")] = (i, m.get_score(i))
        return cls(pieces, byte_ids, min(s for _, s in pieces.values()) - 10, merges)

    def merged(self, text: str) -> list[str]:
        """Merge neighbours while a piece covers both: the best piece first, of equal ones the leftmost."""
        parts, pieces = list(text), self.pieces
        while True:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                hit = pieces.get(parts[i] + parts[i + 1])
                if hit is not None and hit[1] > best:
                    best, at = hit[1], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, a: str, b: str) -> bool:
        """Whether piece b may stand after piece a (or at the start, where a is empty)."""
        pair = (a, b)
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def _ending(self, text: str, n: int) -> list[str]:
        """Pieces that end at place n of text, shortest first; a character that no piece covers stands for itself."""
        node, out, i = self.trie, [], n
        while i:
            i -= 1
            node = node.get(text[i])
            if node is None:
                break
            piece = node.get("")
            if piece is not None:
                out.append(piece)
        if text[n - 1] not in self.pieces:
            out.insert(0, text[n - 1])
        return out

    def _step(self, window: str, scores: list[float], tails: list[str]) -> tuple[int, float]:
        """(length, score) of the best last piece at the window's end; scores and tails end with those before its last character."""
        best, length = -math.inf, 1
        for piece in reversed(self._ending(window, len(window))):
            k, hit = len(piece), self.pieces.get(piece)
            score = scores[-k] + (hit[1] if hit is not None else self.byte_score * len(piece.encode()))
            if score > best and (not self.merges or self.may_follow(tails[-k], piece)):
                best, length = score, k
                if self.merges:  # no other piece may stand here
                    break
        return length, best

    def _tail(self, text: str, n: int, tails: list[str | None]) -> str:
        """The last piece of the only path to place n under merges; works out those boundaries alone that it asks for."""
        for piece in reversed(self._ending(text, n)):
            at = n - len(piece)
            before = tails[at]
            if self.may_follow(self._tail(text, at, tails) if before is None else before, piece):
                tails[n] = piece
                return piece
        raise AssertionError(text)

    def _ids(self, piece: str) -> list[int]:
        hit = self.pieces.get(piece)
        return [hit[0]] if hit is not None else [self.byte_ids[b] for b in piece.encode()]

    def stream(self, characters: Iterable[str]) -> Iterator[list[int]]:
        """Viterbi over a stream of characters; yields ids as soon as they are certain."""
        reach = self.reach
        window, scores, tails = "", [0.0], [""]  # of the boundaries in reach
        up, text, kids, kin = {0: 0}, {0: ""}, {0: 0}, {0: 0}  # per boundary: where its piece starts, the piece, number and sum of its children
        root = n = 0
        for c in characters:
            n += 1
            window = (window + c)[-reach:]
            length, score = self._step(window, scores, tails)
            scores.append(score)
            tails.append(window[-length:])
            if len(scores) > reach:
                del scores[0], tails[0]
            i = n - length
            up[n], text[n], kids[n], kin[n] = i, tails[-1], 0, 0
            kids[i] += 1
            kin[i] += n
            i = n - reach  # out of reach from now on
            while i >= root and not kids[i] and i != root:
                j = up.pop(i)
                del text[i], kids[i], kin[i]
                kids[j] -= 1
                kin[j] -= i
                i = j
                if i > n - reach:
                    break
            sure: list[int] = []
            while root <= n - reach and kids[root] == 1:
                child = kin[root]
                sure += self._ids(text[child])
                del up[root], text[root], kids[root], kin[root]
                root = child
            if sure:
                yield sure
        path = []
        while n != root:
            path.append(text[n])
            n = up[n]
        yield [i for piece in reversed(path) for i in self._ids(piece)]

    def _whole(self, chunk: str) -> bytes:
        """Ids of a chunk. Within a piece's reach nothing can be committed early, so the path is found from its end."""
        if len(chunk) > self.reach or not self.merges:
            return np.array([i for ids in self.stream(chunk) for i in ids], "<u4").tobytes()
        tails: list[str | None] = ["", *[None] * len(chunk)]
        path, n = [], len(chunk)
        while n:
            path.append(tails[n] or self._tail(chunk, n, tails))
            n -= len(path[-1])
        return b"".join([i.to_bytes(4, "little") for piece in reversed(path) for i in self._ids(piece)])

    def _new(self, chunk: str) -> bytes:
        ids = self._whole(chunk)
        if len(chunk) <= LONGEST:
            if len(self.known) >= KEPT:
                self.known.clear()
            self.known[chunk] = ids
        return ids

    def encoded(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text, with the usual space put before it."""
        if not text:
            return b""
        known, new = self.known.get, self._new
        return b"".join([known(c) or new(c) for c in self.chunks(" " + text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.texts.__getitem__, ids)).decode()[1:]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(file: str = MODEL) -> Vocabulary:
    if file not in _LOADED:
        _LOADED[file] = Vocabulary.load(file)
    return _LOADED[file]


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", file: str = MODEL) -> DataFrame:
    """One row per input row: id, ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(file)
        for b in sliced(batches):
            ids = [v.encoded(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["id", "ids"])
        v.known.clear()
        v.pairs.clear()
        trim()

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids binary")


def decode(df: DataFrame, file: str = MODEL) -> DataFrame:
    """encode()'s rows with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(file)
        for b in batches:
            texts = [v.decode(np.frombuffer(x, "<u4").tolist()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["id", "ids", "text"])

    return df.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, ids binary, text string")
