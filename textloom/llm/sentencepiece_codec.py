"""SentencePiece encoding and decoding with a public model, by a forward pass over a trie of distinct words.

The model's own normaliser marks the text; marked words (a run of marks and what follows) never merge with each other, so a text's
pieces are those of its words. The distinct words of a batch are sorted, which lays their trie out in depth-first order: going from
a word to the next, the forward states of the common prefix stay and only the rest is computed.

The forward state of a prefix is the last piece of its encoding. For a unigram model that is Viterbi's best path by summed score.
For a BPE model summed scores don't give the model's pieces, so the state is defined by the merges: a piece ends the prefix's
encoding if it and the last piece before it stay apart when the two are encoded together. There is exactly one such piece, and
following the last pieces backwards gives what the merges give, piece for piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Finer words, for vocabularies without a piece in which Latin letters, digits and other characters meet.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PART = re.compile(f"{MARK}*[{LETTERS}]+|{MARK}*[0-9]+|{MARK}*[^{LETTERS}0-9{MARK}]+|{MARK}+")
#: Words whose pieces a worker keeps; the store is emptied when full. Longer words than LONG characters aren't kept.
KEPT, LONG = 400_000, 64
#: Pieces that were tried side by side, kept likewise.
PAIRS = 500_000


class Codec:
    """A model's vocabulary and the forward pass. blob: the bytes of the .model file."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in range(n) if not special[i]}
        self.id = {p: sp.piece_to_id(p) for p in self.score}
        self.own = {p: p for p in self.score}  # one string object for each piece, so that stored pairs are small
        #: By the last three characters of a piece: the lengths of the pieces that end so, longest first.
        tails: dict[str, set[int]] = {}
        for p in self.score:
            if len(p) > 2:
                tails.setdefault(p[-3:], set()).add(len(p))
        self.tails = {t: tuple(sorted(x, reverse=True)) for t, x in tails.items()}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = all(sp.is_byte(i) for i in self.byte)
        self.unk = sp.unk_id()
        self.raw = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        if self.unk >= 0 and not self.fallback:
            self.raw[self.unk] = b" \xe2\x81\x87 "
        self.dummy = sp.normalize("a") == MARK + "a"
        # Scores of BPE models are minus the merge's rank; a text on which the two kinds of model differ isn't needed to tell them.
        self.bpe = self._is_bpe(blob)
        self.apart: dict[tuple[str, str], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.cut = PART if all(len(PART.findall(p)) == 1 for p in self.score) else WORD

    @staticmethod
    def _is_bpe(blob: bytes) -> bool:
        """trainer_spec.model_type (field 2, then 3) of the model's protobuf: 1 is unigram (the default), 2 is BPE."""
        return _field(_field(blob, 2, b""), 3, 1) == 2

    # --- encoding ---

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by the merges themselves: best score first, leftmost among equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces stay apart when encoded together."""
        got = self.apart.get((left, right))
        if got is None:
            if len(self.apart) >= PAIRS:
                self.apart.clear()
            got = self.apart[(left, right)] = self.merged(left + right) == ([left, right] if left else [right])
        return got

    def by_merges(self, word: str, same: int, last: list[str]) -> None:
        """Append the forward states of word's prefixes of over `same` characters; those of the shorter ones are there."""
        own, tails, apart = self.own, self.tails, self.apart
        for end in range(same + 1, len(word) + 1):
            for n in tails.get(word[end - 3 : end], ()) if end > 2 else ():
                if n <= end:
                    piece = own.get(word[end - n : end])
                    if piece is not None:
                        left = last[end - n]
                        fits = apart.get((left, piece))
                        if fits or fits is None and self.fits(left, piece):
                            last.append(piece)
                            break
            else:
                two = own.get(word[end - 2 : end]) if end > 1 else None
                last.append(two if two is not None and self.fits(last[end - 2], two) else own.get(word[end - 1], word[end - 1]))

    def by_scores(self, word: str, same: int, last: list[str], best: list[float]) -> None:
        """The same for the best path of summed scores, with the sums beside."""
        score = self.score
        for end in range(same + 1, len(word) + 1):
            top, chosen = best[end - 1] + score.get(word[end - 1], self.unknown_score), word[end - 1]
            for n in (*self.tails.get(word[end - 3 : end], ()), 2) if end > 2 else (2,):
                s = score.get(word[end - n : end]) if n <= end else None
                if s is not None and best[end - n] + s > top:
                    top, chosen = best[end - n] + s, word[end - n : end]
            last.append(chosen)
            best.append(top)

    @property
    def unknown_score(self) -> float:
        return min(self.score.values(), default=0.0) - 10.0

    def ids_of(self, pieces: Iterable[str]) -> tuple[int, ...]:
        out: list[int] = []
        for p in pieces:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out += [self.byte[b] for b in p.encode("utf-8")]
            else:
                out.append(self.unk)
        return tuple(out)

    def learn(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Pieces of the given words: sorted, so that the states of a common prefix are computed once."""
        found: dict[str, tuple[int, ...]] = {}
        before, last, best = "", [""], [0.0]
        for word in sorted(words):
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1 :], best[same + 1 :]
            if self.bpe:
                self.by_merges(word, same, last)
            else:
                self.by_scores(word, same, last, best)
            before = word
            pieces, at = [], len(word)
            while at:
                pieces.append(last[at])
                at -= len(last[at])
            found[word] = self.ids_of(reversed(pieces))
        return found

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """The model's piece ids of each text."""
        cut = [self.cut.findall(self.sp.normalize(t)) if t else [] for t in texts]
        kept = self.words
        new: set[str] = set()
        for words in cut:
            new.update(w for w in words if w not in kept)
        fresh = self.learn(new)
        if len(kept) + len(fresh) > KEPT:
            # Words of this batch that were known go with the others; they are found again below.
            old = {w: kept[w] for words in cut for w in words if w in kept}
            kept.clear()
            fresh |= old
        kept.update((w, i) for w, i in fresh.items() if len(w) <= LONG and len(kept) < KEPT)
        out = []
        for words in cut:
            ids: list[int] = []
            for w in words:
                ids += fresh[w] if w in fresh else kept[w]
            out.append(ids)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of piece ids; broken UTF-8 among byte pieces becomes U+FFFD."""
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy and text[:1] == " " else text


def _field(blob: bytes, number: int, default):
    """The first field of that number in a protobuf message: bytes or an integer."""
    at = 0

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            b = blob[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(blob):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value = blob[at : at + size]
            at += size
        else:
            value = blob[at : at + (8 if kind == 1 else 4)]
            at += 8 if kind == 1 else 4
        if key >> 3 == number:
            return value
    return default


_LOADED: dict[int, Codec] = {}


def codec(blob: bytes) -> Codec:
    """One codec per worker process and model, so that the pairs that were tried last from task to task."""
    key = hash(blob)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Codec(blob)
    return _LOADED[key]


def model_bytes(spark, path: str):
    """The model file (under 1 MB for the public ones), read on the driver once and broadcast."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text", rows: int = 256) -> DataFrame:
    """Per row of docs: doc_id, ids array<int>, n_pieces, decoded, round_trip (whether decoding gives the normalised text back).

    Null and empty texts have no pieces and decode to the empty text. A mark (U+2581) in a text reads as a space, as in the model.
    Repeated rows are encoded alike; other columns aren't read. rows: texts whose words share a trie.
    """
    blob = model_bytes(docs.sparkSession, model)

    def run(batches):
        c = codec(blob.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, rows):
                part = [t or "" for t in texts.slice(at, rows).to_pylist()]
                coded = c.encode_batch(part)
                back = [c.decode(x) for x in coded]
                same = [b == t or b == t.replace(MARK, " ") or b == c.sp.normalize(t).replace(MARK, " ")[1 if c.dummy else 0 :] for b, t in zip(back, part)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, rows), pa.array(coded, pa.list_(pa.int32())), pa.array(list(map(len, coded)), pa.int64()), pa.array(back, pa.string()), pa.array(same)],
                    ["doc_id", "ids", "n_pieces", "decoded", "round_trip"],
                )
        c.words.clear()  # a worker that goes on to other stages keeps the pairs alone

    schema = "doc_id bigint, ids array<int>, n_pieces bigint, decoded string, round_trip boolean"
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(coded: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row of coded: doc_id and text. Null ids decode to the empty text."""
    blob = model_bytes(coded.sparkSession, model)

    def run(batches):
        c = codec(blob.value)
        for batch in batches:
            texts = [c.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id bigint, text string")
