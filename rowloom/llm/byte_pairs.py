"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file names byte strings.  The library works on characters, so every byte gets one
(``byte_letters``), tokens become words over these letters, and the merge list is read
off the ranks: the merges that lead to a token are those of lower rank, and the last two
parts are its pair.  Texts go to the library in portions of bounded size; a text longer
than a portion is taken apart in front of white space behind other text, where every
match of the pattern ends, so ids do not depend on the cut.

Decoding reverses the byte table: a token is a byte string, a text the concatenation of
its tokens' bytes, joined by Arrow over whole portions.  A character may be divided over
tokens.  ``starts`` and ``ends`` (in code points) then give each of these tokens the
whole character, and ``pieces_of`` gives the character to the token that completes it.

The work is a projection of Arrow batches: no shuffle, memory is one batch, one portion
and the vocabulary.  A lost executor costs its own tasks.

Defined cases: null and empty texts have no tokens and decode to the empty text; null
ids decode to null; an id outside the vocabulary is an error; bytes that form no
character decode to replacement characters; repeated rows get equal results; an empty
table gives an empty result; columns not asked for are not read, and those to ``carry``
keep their names, which must differ from the result's.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from rowloom.errors import DataError
from rowloom.llm.common import portions, text_of

#: Code points given to the library at once, and rows of one portion.
PORTION, ROWS = 1 << 20, 1024
# White space behind other text: every match ends in front of it.
_CUT = re.compile(r"(?<=\S)(?=[ \n\t])")


def byte_letters() -> list[str]:
    """A character for each byte: its own where that is printable, else the next one above 255."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    above = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(above)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts whose merge gives ``token``, after all merges of lower rank; None if others remain."""
    own, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(found)
        if rank >= own:
            return None
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class BytePairs:
    """A rank vocabulary for the library, and its tables by id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        letters = byte_letters()
        spelled = {token: "".join(letters[b] for b in token) for token in ranks}
        by_rank = sorted(ranks, key=ranks.get)
        pairs = [last_pair(t, ranks) for t in by_rank if len(t) > 1]
        # A token no merge leads to is met only as a whole match, as in the rank file's own library.
        self.library = Tokenizer(
            models.BPE(
                {spelled[t]: i for t, i in ranks.items()},
                [(spelled[p[0]], spelled[p[1]]) for p in pairs if p],
                ignore_merges=True,
            )
        )
        self.library.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        byte_of = {letter: b for b, letter in enumerate(letters)}
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = bytes(byte_of[c] for c in spelled[token])
        self.bytes = pa.array(table, pa.binary())
        self.decimal = pa.array([str(i) for i in range(len(table))], pa.string())
        inside = [[b & 0xC0 == 0x80 for b in t] for t in table]
        #: Characters that begin in a token, and whether its first byte continues one.
        self.begun = np.array([len(x) - sum(x) for x in inside], np.int64)
        self.split = np.array([bool(x) and x[0] for x in inside])
        self.known = np.array([bool(t) for t in table])

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (one bound more than texts)."""
        bits, owner = [], []
        for i, text in enumerate(texts):
            cut = cuts(text)
            bits += cut
            owner += [i] * len(cut)
        found = [e.ids for e in self.library.encode_batch(bits, add_special_tokens=False)]
        sizes = np.bincount(np.array(owner, np.int64), [len(ids) for ids in found], len(texts)).astype(np.int64)
        flat = np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum()))
        return flat, np.concatenate([[0], np.cumsum(sizes)])

    def join(self, table: pa.Array, ids: np.ndarray, bounds: np.ndarray, between: str | bytes) -> pa.Array:
        """Entries of a table by id, joined per text."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), table.take(pa.array(ids))), between)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The bytes of each text."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise DataError("an id is not in the vocabulary", "bpe_unknown_id")
        return self.join(self.bytes, ids, bounds, b"")

    def offsets(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and behind-last code point of each token; parts of a character have all of it."""
        total = np.concatenate([[0], np.cumsum(self.begun[ids])])
        base = np.repeat(total[bounds[:-1]], np.diff(bounds))
        return total[:-1] - base - self.split[ids], total[1:] - base

    def pieces_of(self, ids: Sequence[int]) -> list[str]:
        """Text of each token; a divided character belongs to the token that completes it."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        last = len(ids) - 1
        return [decoder.decode(self.bytes[int(i)].as_py(), n == last) for n, i in enumerate(ids)]


def cuts(text: str, size: int = PORTION) -> list[str]:
    """``text``, taken apart in front of white space where it is longer than ``size``."""
    out, start = [], 0
    while len(text) - start > size:
        found = _CUT.search(text, start + size)
        if found is None:
            break
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]] if start else [text]


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str) -> BytePairs:
    """Once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return BytePairs(read_ranks(path), pattern)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def encode_documents(
    df: DataFrame,
    ranks: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, n_tokens, n_split, ids_sha256, decoded_sha256, and the columns to ``carry``.

    ``n_split`` counts tokens that begin inside a character.  ``keep_ids`` adds ``ids``,
    ``starts`` and ``ends``.  The digest of the decoded bytes is of ids turned back.
    """
    source = df.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"), *[F.col(f"`{c}`") for c in carry])
    schema = T.StructType([source.schema["doc_id"]])
    for name in ("n_tokens", "n_split"):
        schema.add(name, T.LongType())
    for name in ("ids_sha256", "decoded_sha256"):
        schema.add(name, T.StringType())
    for name in ("ids", "starts", "ends") if keep_ids else ():
        schema.add(name, T.ArrayType(T.IntegerType()))
    for c in carry:
        schema.add(source.schema[c])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(ranks, pattern)
        for batch in batches:
            for part in portions(batch, pc.binary_length(batch.column(1)).to_pylist(), ROWS, PORTION):
                ids, bounds = pairs.encode(part.column(1).to_pylist())
                split = np.concatenate([[0], np.cumsum(pairs.split[ids])])[bounds]
                joined = pairs.join(pairs.decimal, ids, bounds, " ")
                out = [
                    part.column(0),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(np.diff(split), pa.int64()),
                    pa.array([hashlib.sha256(s.encode()).hexdigest() for s in joined.to_pylist()], pa.string()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in pairs.decode(ids, bounds).to_pylist()], pa.string()),
                ]
                if keep_ids:
                    out += [_lists(v, bounds) for v in (ids, *pairs.offsets(ids, bounds))]
                out += [part.column(2 + i) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return source.mapInArrow(run, schema)


def decode_documents(df: DataFrame, ranks: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of a column of ids."""
    source = df.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{ids}`").cast("array<int>").alias(text))
    schema = T.StructType([*df.schema, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(ranks, pattern)
        for batch in batches:
            for part in portions(batch, pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0).to_pylist(), ROWS, PORTION):
                lists = part.column(part.num_columns - 1)
                flat = lists.flatten()
                if flat.null_count:
                    raise DataError("an id is null", "bpe_unknown_id")
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                raw = pairs.decode(flat.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])).to_pylist()
                whole = [b.decode("utf-8", "replace") if v else None for b, v in zip(raw, lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(whole, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)
