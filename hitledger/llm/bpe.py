"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is one valid last token: the last token of the prefix's own
encoding. ``last[i]`` stores it for the prefix of length i. Of the tokens that end at i, it is the
only one that may follow ``last[i - len(token)]``, where "may follow" means that merging the two
tokens' bytes on their own gives these two tokens again. So a table of valid pairs decides each
prefix, encodings of all prefixes come for free, an append continues the table, and an edit
recomputes it only from the edit until it agrees with the old one again.

Merging goes by rank alone, lowest first, leftmost among equals, as rank files mean it. A sequence
whose neighbours may all follow each other is the encoding, because no merge can cross a border
before one crosses it in the pair alone.

Texts are first cut by a pattern; every match is encoded separately. Encoding and decoding run per
row in Arrow batches, without shuffles. Pieces and pairs met before are remembered per task, up to
a bound beyond which the memory starts anew; that changes no result.

Defined results: null and empty text give no ids; decoding null ids gives no bytes; an id outside
the vocabulary raises; an empty table gives an empty result; a column named like the output is
replaced.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bound of the pieces and pairs a task remembers.
REMEMBERED = 400_000
#: Bytes of input that a task takes at a time.
SLICE = 1 << 20
#: Lengths of the heads of pieces whose tables are kept.
HEADS = (4, 8)


class Vocabulary:
    """Ranks of byte strings, with the tables that the prefix rule needs."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.lengths = [len(self.tokens.get(i, b"")) for i in range(max(self.tokens) + 1)]
        self.longest = max(map(len, self.ranks))
        # by first token: whether a second one may follow
        self.followers: list[dict[int, bool]] = [{} for _ in self.lengths]
        self.n_pairs = 0
        self.alone: dict[int, bool] = {}
        self.heads: dict[bytes, list[int]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Merging by rank, for short strings: the definition that the pair table rests on."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] == 1 << 60:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, first: int, second: int) -> bool:
        known = self.followers[first].get(second)
        if known is None:
            if self.n_pairs >= REMEMBERED // 2:
                self.followers, self.n_pairs = [{} for _ in self.lengths], 0
            known = self.merged(self.tokens[first] + self.tokens[second]) == [first, second]
            self.followers[first][second] = known
            self.n_pairs += 1
        return known

    def stands_alone(self, token: int) -> bool:
        known = self.alone.get(token)
        if known is None:
            known = self.alone[token] = self.merged(self.tokens[token]) == [token]
        return known

    def extend(self, piece: bytes, last: list[int], until: int | None = None) -> None:
        """Continues the table ``last`` (one entry per prefix, the empty one first) over ``piece``."""
        ranks = self.ranks.get
        for end in range(len(last), (len(piece) if until is None else until) + 1):
            start = end
            while start:
                start -= 1
                token = ranks(piece[start:end])
                if token is None:
                    continue
                if start:
                    before = last[start]
                    follows = self.followers[before].get(token)
                    if follows is None:
                        follows = self.may_follow(before, token)
                else:
                    follows = self.stands_alone(token)
                if follows:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks single bytes")

    def backwards(self, last: list[int]) -> list[int]:
        """The encoding of the longest prefix, read from the table's end."""
        ids, at, lengths = [], len(last) - 1, self.lengths
        while at:
            token = last[at]
            ids.append(token)
            at -= lengths[token]
        ids.reverse()
        return ids

    def piece_ids(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last = self.table(piece)
        return self.backwards(last)

    def table(self, piece: bytes) -> list[int]:
        """The table of a string, as an append to that of its first bytes, which is kept."""
        if len(piece) <= HEADS[0]:
            last = [-1]
        else:
            head = piece[: HEADS[1] if len(piece) > HEADS[1] else HEADS[0]]
            known = self.heads.get(head)
            if known is None:
                if len(self.heads) >= REMEMBERED // 8:
                    self.heads.clear()
                known = self.heads[head] = self.table(head)
            last = known.copy()
        self.extend(piece, last)
        return last

    def encode(self, text: str) -> list[int]:
        return [i for m in self.pattern.finditer(text) for i in self.piece_ids(m.group().encode())]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """The table of one byte string, kept up to date under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.vocabulary.extend(self.piece, self.last)

    def replace(self, start: int, stop: int, by: bytes) -> int:
        """Puts ``by`` for the bytes from start to stop; returns how many entries were recomputed.

        An entry depends on at most ``longest`` entries before it, so once as many in a row equal
        the old ones, all that follow do.
        """
        old, shift = self.last, len(by) - (stop - start)
        self.piece = self.piece[:start] + by + self.piece[stop:]
        last, same, end = old[: start + 1], 0, start
        while end < len(self.piece):
            end += 1
            self.vocabulary.extend(self.piece, last, end)
            # only entries whose tokens lie behind the edit can vouch for later ones
            behind = end - shift > stop
            same = same + 1 if behind and last[end] == old[end - shift] else 0
            if same > self.vocabulary.longest:
                last += old[end - shift + 1 :]
                break
        self.last = last
        return end - start

    def ids(self, length: int | None = None) -> list[int]:
        """The encoding of the whole string or of any prefix."""
        return self.vocabulary.backwards(self.last if length is None else self.last[: length + 1])


def append_text(vocabulary: Vocabulary, text: str, more: str) -> tuple[int, list[int]]:
    """Re-encodes near an append: (ids of ``text`` that stay, ids that follow them).

    A match of the pattern is settled if neither its longest alternative nor its look-ahead
    reaches the end of ``text``. Everything from the first match that isn't is encoded anew.
    """
    kept, at = 0, 0
    for match in vocabulary.pattern.finditer(text):
        if match.end() + 1 >= len(text) or match.start() + 3 > len(text):
            break
        kept += len(vocabulary.piece_ids(match.group().encode()))
        at = match.end()
    return kept, vocabulary.encode(text[at:] + more)


class _Pieces(dict):
    """Piece of text -> its ids as little-endian 32-bit numbers, computed when first asked for.

    When full it becomes the older generation, from which pieces come back when they recur.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            packed = array("I", self.vocabulary.piece_ids(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


@functools.cache
def loaded(path: str, pattern: str) -> tuple[Vocabulary, _Pieces, list[bytes | None]]:
    """Once per Python worker."""
    vocabulary = Vocabulary(path, pattern)
    table = [vocabulary.tokens.get(i) for i in range(max(vocabulary.tokens) + 1)]
    return vocabulary, _Pieces(vocabulary), table


def packed_ids(text: str | None, path: str, pattern: str) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers, with the memory of the task."""
    vocabulary, pieces, _ = loaded(path, pattern)
    return b"".join(map(pieces.__getitem__, vocabulary.pattern.findall(text or "")))


def unpacked_text(ids: bytes | None, path: str, pattern: str) -> bytes:
    table = loaded(path, pattern)[2]
    try:
        return b"".join(map(table.__getitem__, memoryview(ids or b"").cast("I")))
    except (IndexError, TypeError) as error:
        raise ValueError("an id is outside the vocabulary") from error


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def _with_columns(docs: DataFrame, given: str, keep: list[str], made: dict) -> DataFrame:
    """``keep`` and new binary columns; each of ``made`` maps the value before it, ``given`` at first.

    Rows go out in slices of about a megabyte of input, so a task holds little at a time.
    """
    fields = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.BinaryType()) for c in made)])
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(0)), 0).to_numpy(zero_copy_only=False)
            ends = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE, prepend=0)) + 1
            for start, stop in zip([0, *ends], [*ends, whole.num_rows]):
                part = whole.slice(start, stop - start)
                values, columns = part.column(0).to_pylist(), []
                for make in made.values():
                    values = [make(v) for v in values]
                    columns.append(pa.array(values, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=names)

    return docs.select(F.col(given).alias("__given"), *keep).mapInArrow(run, fields)


def encode_column(
    docs: DataFrame,
    files: tuple[str, str],
    text: str = "text",
    out: str = "ids",
    decoded: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds ``out``, the ids as little-endian unsigned 32-bit numbers, and what they decode to.

    Of the other columns all stay, or those that ``keep`` names.
    """
    made = {out: lambda value: packed_ids(value, *files)}
    if decoded:
        made[decoded] = lambda value: unpacked_text(value, *files)
    return _with_columns(docs, text, keep or [c for c in docs.columns if c not in made], made)


def decode_column(docs: DataFrame, files: tuple[str, str], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the bytes that the ids stand for."""
    made = {out: lambda value: unpacked_text(value, *files)}
    return _with_columns(docs, ids, [c for c in docs.columns if c != out], made)


def sha256(data: Column) -> Column:
    return F.sha2(data, 256)


def encoded_digests(docs: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    files = files or default_files()
    both = encode_column(docs, files, decoded="decoded", keep=["doc_id"])
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        sha256(F.col("ids")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encoded_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
