"""SentencePiece encoding and decoding with a streaming Viterbi search.

The search runs over the characters of a text and keeps, for each position since the last
final boundary, the best piece that ends there. A path goes on from one of the last positions only,
as many as the longest piece has characters. Each time so many have been read, the paths back from
them are compared: where all meet, what lies before is final, its ids are given
out and its positions forgotten. Memory does not follow the text.

What a path is worth depends on the kind of model. A ``unigram`` model adds the scores
of the pieces. In a ``bpe`` model scores rank merges, and the sum of them does not give that model's
segmentation; there, a step is possible only if the two pieces, spelled out and merged by rank, come
out as these two pieces. A sequence of pieces is the model's segmentation exactly if all its
neighbours pass, so one path survives to each position, and the ids equal those of the library.

Characters that no piece covers become their UTF-8 bytes, or the unknown id in a
model without byte pieces.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstream.llm.common import crc32_of, for_texts, text_of
from sensorstream.llm.words import Memo

#: Models write a space as this mark; inside, it is a space, which keeps words in one byte a letter.
MARK = "▁"
#: Two pieces in one number: ids and complements of code points lie within half of this. No piece yet.
PAIR, START = 1 << 33, 1 << 31
#: Extra loss of a character without a piece, below the worst piece.
UNKNOWN_LOSS = 10.0
#: Words a worker keeps with their ids, and pairs of pieces with their test.
KEPT_WORDS, KEPT_PAIRS = 400_000, 300_000


class PieceModel:
    """The pieces of a SentencePiece model file."""

    def __init__(self, path: str | None, kind: str = "bpe", proto: bytes | None = None) -> None:
        import sentencepiece

        if kind not in ("bpe", "unigram"):
            raise ValueError(f"kind {kind}: bpe or unigram")
        library = sentencepiece.SentencePieceProcessor(
            **({"model_proto": proto} if proto is not None else {"model_file": path})
        )
        self.kind, self.library = kind, library
        ids = range(library.get_piece_size())
        self.pieces = [library.id_to_piece(i).replace(MARK, " ") for i in ids]
        normal = [
            i for i in ids if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
        ]
        self.id_of = {self.pieces[i]: i for i in normal}
        self.score = {self.pieces[i]: library.get_score(i) for i in normal}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in ids if library.is_byte(i)}
        self.unknown = library.unk_id()
        self.longest = max(map(len, self.id_of), default=1)
        self.worst = min(self.score.values(), default=0.0) - UNKNOWN_LOSS
        self.cut = self._cuts()
        #: Pieces that a bpe model can give: spelled out, they come out in one.
        self.usable = {p: i for p, i in self.id_of.items() if kind == "bpe" and self.merged(p) == [p]}
        self.lengths = list(map(len, self.pieces))
        self.neighbours = Memo(self._come_out, KEPT_PAIRS)
        self.spelling: list[bytes] = []
        for i in ids:
            if library.is_byte(i):
                self.spelling.append(bytes([int(self.pieces[i][1:-1], 16)]))
            elif library.is_control(i):
                self.spelling.append(b"")
            elif library.is_unknown(i):
                self.spelling.append(" ⁇ ".encode())
            else:
                self.spelling.append(self.pieces[i].encode())

    def _cuts(self) -> re.Pattern[str]:
        """Parts of a text between boundaries where all paths meet, whatever the text.

        That is so between two characters that no piece holds on end. Used are those before
        a space, and between a letter and an ASCII mark, if this model has no such piece.
        """
        held: dict[str, set[str]] = {}
        for piece in self.id_of:
            for a, b in zip(piece, piece[1:]):
                held.setdefault(b, set()).add(a)
        if held.get(" ", set()) - {" "}:
            return re.compile("(?s).+")
        free = [m for m in string.punctuation if m != "_" and not any(a.isalpha() for a in held.get(m, ()))]
        marks, letter = "".join(map(re.escape, free)) + " ", r"[^\W\d_]"
        return re.compile(
            rf" *{letter}+(?![^{marks}])| *[^ ]+?(?:(?<={letter})(?=[{marks}])|(?= )|\Z)| +", re.DOTALL
        )

    def normalized(self, text: str) -> str:
        """The text that is cut into pieces, with plain spaces."""
        return self.library.normalize(text).replace(MARK, " ")

    def merged(self, text: str) -> list[str]:
        """Merge characters by rank, the leftmost of equals first: short texts only."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            best = max(ranks)
            if best == -np.inf:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def spelled(self, piece: int) -> str:
        return self.pieces[piece] if piece >= 0 else chr(~piece)

    def length(self, piece: int) -> int:
        return self.lengths[piece] if piece >= 0 else 1

    def _come_out(self, pair: int) -> bool:
        """Whether two pieces, spelled out on end and merged, come out as they are."""
        left, right = divmod(pair + PAIR // 2, PAIR)
        both = [self.spelled(left), self.spelled(right - PAIR // 2)]
        return self.merged("".join(both)) == both

    def fallback(self, piece: int) -> list[int]:
        """The ids of a character without a piece."""
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in chr(~piece).encode()]


class StreamingViterbi:
    """Feed text; final ids come out as soon as they are certain.

    A character without a piece stands as the complement of its code point, which is negative, until it is final.
    """

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.text = ""  # characters since the last final boundary
        #: The best piece that ends at each position of the window; at 0, the final piece before it.
        self.last: list[int | None] = [START]
        self.worth = [0.0]  # of the path to each position, for unigram models
        self.widest = 0

    def feed(self, text: str) -> list[int]:
        """Read on; the ids that became final."""
        out, longest = [], self.model.longest
        for begin in range(0, len(text), longest):
            self.text += text[begin : begin + longest]
            if self.model.kind == "bpe":
                self._by_merges()
            else:
                self._by_scores()
            if len(self.text) > 2 * longest:
                self.widest = max(self.widest, len(self.text))
                out += self._certain()
        return out

    def close(self) -> list[int]:
        """The ids up to the end of the text."""
        return self._take(len(self.text))

    def _by_merges(self) -> None:
        text, last, longest = self.text, self.last, self.model.longest
        usable, passes = self.model.usable, self.model.neighbours
        for end in range(len(last), len(text) + 1):
            found = None
            for start in range(end - 1, end - longest - 1 if end > longest else -1, -1):
                piece = usable.get(text[start:end])
                if piece is None:
                    if end - start > 1:
                        continue
                    piece = ~ord(text[start])
                before = last[start]
                if before is not None and (before == START or passes[before * PAIR + piece]):
                    found = piece
                    break  # one path passes, so short pieces may be tried first
            last.append(found)

    def _by_scores(self) -> None:
        text, last, worth, model = self.text, self.last, self.worth, self.model
        for end in range(len(last), len(text) + 1):
            best, found = -np.inf, None
            for start in range(max(0, end - model.longest), end):
                piece = text[start:end]
                if piece in model.id_of or end - start == 1:
                    total = worth[start] + model.score.get(piece, model.worst)
                    if total > best:
                        best, found = total, model.id_of.get(piece, ~ord(piece[0]))
            last.append(found)
            worth.append(best)

    def _certain(self) -> list[int]:
        """Give out the ids before the boundary in which all surviving paths meet."""
        end = len(self.text)
        alive = {p for p in range(end - self.model.longest + 1, end + 1) if self.last[p] is not None}
        # The rightmost position of the set steps back until one is left.
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(last - self.model.length(self.last[last]) if last else 0)
        return self._take(alive.pop())

    def _take(self, boundary: int) -> list[int]:
        taken, at, last, lengths = [], boundary, self.last, self.model.lengths
        while at:
            piece = last[at]
            if piece < 0:
                taken += reversed(self.model.fallback(piece))
                at -= 1
            else:
                taken.append(piece)
                at -= lengths[piece]
        if boundary:
            self.text = self.text[boundary:]
            self.last = last[boundary:]
            if self.model.kind != "bpe":
                base = self.worth[boundary]
                self.worth = [w - base for w in self.worth[boundary:]]
        return taken[::-1]


class Encoder:
    """Ids of whole texts. Short parts between certain boundaries are looked up before they are searched."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.words = Memo(self._searched, KEPT_WORDS)

    def _searched(self, segment: str) -> tuple[int, ...]:
        search = StreamingViterbi(self.model)
        return tuple(search.feed(segment) + search.close())

    def segments(self, text: str) -> list[str]:
        """Parts of normalised text between boundaries that all paths share."""
        return self.model.cut.findall(text)

    def encode(self, text: str) -> np.ndarray:
        segments = self.segments(self.model.normalized(text)) if text else []
        return np.fromiter(chain.from_iterable(map(self._ids, segments)), np.uint32)

    def _ids(self, segment: str) -> tuple[int, ...]:
        # Long segments are searched as a stream and not kept.
        return self.words[segment] if len(segment) <= 64 else self._searched(segment)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: marks become spaces, the one that encoding puts first is dropped."""
        spelling = self.model.spelling
        data = b"".join([spelling[i] for i in ids])
        return data.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def encoder_for(path: str, kind: str) -> Encoder:
    """One per Python worker."""
    return Encoder(PieceModel(path, kind))


def encode_documents(
    docs: DataFrame, model: str, *, kind: str = "bpe", id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ids) of every row. Null and empty texts have no ids; rows are encoded one by one."""
    for_texts(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(model, kind)
        for batch in batches:
            found = [encoder.encode(t).view(np.int32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str, *, kind: str = "bpe") -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, text) from (doc_id, ids). Null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(model, kind)
        for batch in batches:
            lists = [np.empty(0, np.int32) if x is None else x for x in batch.column("ids").to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in lists], pa.int64()),
                    pa.array([crc32_of(x) for x in lists], pa.int64()),
                    pa.array([encoder.decode(x.tolist()) for x in lists], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_crc32", "text"],
            )

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, text string")
