"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding follows the definition: a text becomes symbols, one per character, and an
agenda of adjacent pairs, ordered by vocabulary score and then by place, is worked off
until no pair is a piece.  Characters outside the vocabulary become byte pieces.

A merge can only happen inside a piece, so a text falls apart, before any merge, at
every spot that no piece spans: before the white-space mark, and around characters that
occur in no longer piece.  Those spots are read off the vocabulary, not assumed.  Each
distinct part is encoded once and kept in a table that the tasks of a Python worker share,
bounded by its size in memory; the sentencepiece library encodes the same new parts in one call per portion of rows and decodes their ids,
joined, in another, and a difference is an error (a lone mark is only decoded).  So the
check is per distinct part; whole texts are compared in the tests.  The work is a projection of Arrow batches: no shuffle, memory is one batch, the
longest text and the bounded table.  A lost executor costs its own tasks.

Defined cases: null and empty texts have no pieces and decode to the empty text; a
literal white-space mark in a text decodes to a space, as in the library; repeated rows
get equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import operator
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2

from rowloom.llm.common import text_of

MARK = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: Bytes, as estimated, that a worker's table of parts may take before it starts anew.
MAX_KEPT = 300_000_000
_ENTRY = 300  # of a part, beside its characters
_SHORT = 40  # symbols up to which the agenda is a plain list
_NEVER = float("inf")


class MergeVocabulary:
    """Pieces, scores and the places where texts can be taken apart."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds = {p.type for p in proto.pieces}
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or spec.name != "identity" or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("a merge-type model with identity normalisation and a dummy prefix is needed")
        if kinds & {4, 5}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.ids, self.score, self.text, self.bytes, self.unknown = {}, {}, {}, {}, None
        self.byte_of: dict[int, int] = {}
        for i, p in enumerate(proto.pieces):
            if p.type == NORMAL:
                self.ids[p.piece], self.score[p.piece], self.text[i] = i, p.score, p.piece.replace(MARK, " ")
            elif p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value], self.byte_of[i] = i, value
            elif p.type == UNKNOWN:
                self.unknown = i
                self.text[i] = proto.trainer_spec.unk_surface
        self.unknown_surface = proto.trainer_spec.unk_surface
        self.cost = {p: -score for p, score in self.score.items()}
        longer = [p for p in self.ids if len(p) > 1]
        #: Neighbours inside some piece; between all others nothing ever merges.
        self.pairs = {p[i : i + 2] for p in longer for i in range(len(p) - 1)}
        inner = "".join(re.escape(c) for c in sorted({c for p in longer for c in p} - {MARK}))
        if any(MARK in p.lstrip(MARK) for p in longer):
            self.parts = re.compile("(?s).+")
        else:
            self.parts = re.compile(f"(?s){MARK}+[{inner}]*|[{inner}]+|[^{MARK}{inner}]+")

    def apart(self, part: str) -> list[str]:
        """A part cut wherever no piece holds both neighbours."""
        if self.pairs.issuperset(map(operator.add, part, part[1:])):
            return [part]
        cuts = [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in self.pairs]
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])] if cuts else [part]

    def encode_part(self, part: str) -> list[int]:
        """Pair agenda over one part: best score first, then leftmost."""
        symbols = list(part)
        if len(symbols) > _SHORT:
            self._merge_long(symbols)
        else:
            self._merge_short(symbols)
        out = list(map(self.ids.get, symbols))
        if None not in out:
            return out
        out = []
        for s in symbols:
            if s in self.ids:
                out.append(self.ids[s])
            elif s and self.bytes:
                out += [self.bytes[b] for b in s.encode("utf-8")]
            elif s:
                out.append(self.unknown)
        return out

    def _merge_short(self, symbols: list[str]) -> None:
        """The agenda as a list, one entry per neighbouring pair; its least entry is next."""
        cost = self.cost.get
        agenda = [cost(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == _NEVER:
                break
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + symbols[i], _NEVER)
            if i < len(agenda):
                agenda[i] = cost(symbols[i] + symbols[i + 1], _NEVER)

    def _merge_long(self, symbols: list[str]) -> None:
        """The agenda as a heap; outdated entries are passed over."""
        n, score = len(symbols), self.score
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []

        def offer(i: int, j: int) -> None:
            joined = symbols[i] + symbols[j]
            found = score.get(joined)
            if found is not None:
                heapq.heappush(agenda, (-found, i, j, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, joined = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or right[i] != j or symbols[i] + symbols[j] != joined:
                continue
            symbols[i], symbols[j] = joined, ""
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
                offer(i, right[j])
            if left[i] >= 0:
                offer(left[i], i)

    def split(self, text: str) -> list[str]:
        return self.parts.findall((MARK + text).replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for part in self.split(text) for i in self.encode_part(part)]

    def surface(self, ids: list[int]) -> str:
        """Text of some ids; bytes that form no character become replacement characters."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.text.get(i, "") for i in ids])
        out, waiting = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                waiting.append(self.byte_of[i])
                continue
            if waiting:
                out.append(_characters(waiting))
                waiting = bytearray()
            out.append(self.text.get(i, ""))
        if waiting:
            out.append(_characters(waiting))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Without the space that encoding put in front."""
        first = next((i for i in ids if i in self.byte_of or i in self.text), None)
        return self.surface(ids) if first == self.unknown else _unprefixed(self.surface(ids))


def _unprefixed(text: str) -> str:
    return text[1:] if text[:1] == " " else text


def _characters(raw: bytes) -> str:
    """UTF-8 characters; each byte that belongs to none is one replacement character."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(bytes(raw[i : i + n]).decode("utf-8"))
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


class CheckedParts:
    """Ids (as text) and surface of each distinct part, compared with the library."""

    def __init__(self, path: str, check: bool = True):
        model = _read(path)
        self.vocabulary = MergeVocabulary(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model) if check else None
        self.ids: dict[str, str] = {}
        #: Surfaces that are not the part itself with spaces for marks.
        self.surfaces: dict[str, str] = {}
        self.pieces: dict[str, list[int]] = {}
        self.size = 0
        self.head = self.library.encode("\n") if check else []

    def learn(self, parts: set[str]) -> None:
        """Encode what is new among ``parts``; all of them are known afterwards."""
        new = [p for p in parts if p not in self.ids]
        if self.size > MAX_KEPT:
            self.ids, self.surfaces, self.pieces, self.size, new = {}, {}, {}, 0, list(parts)
        # Ids as text take up to about six bytes, in lists eight, a character of the part and its surface up to four each.
        self.size += sum(_ENTRY + 14 * len(p) for p in new)
        found = []
        for p in new:
            bits = self.vocabulary.apart(p)
            if len(bits) == 1:
                found.append(self.vocabulary.encode_part(p))
                continue
            ids: list[int] = []
            for bit in bits:
                known = self.pieces.get(bit)
                if known is None:
                    known = self.pieces[bit] = self.vocabulary.encode_part(bit)
                    self.size += _ENTRY + 12 * len(bit)
                ids += known
            found.append(ids)
        if self.library is not None and new:
            # The library puts a mark in front; a part without one stands behind a line feed.
            marked = [p[0] == MARK for p in new]
            asked = self.library.encode(
                [p[1:].replace(MARK, " ") if m else "\n" + p for p, m in zip(new, marked)], num_threads=1
            )
            for part, own, m, other in zip(new, found, marked, asked):
                if part != MARK and own != (other if m else other[len(self.head) :]):
                    raise AssertionError(f"encoding of {part!r} differs from the library: {own}, {other}")
        surfaces = [self.vocabulary.surface(own) for own in found]
        if self.library is not None and new:
            self._check_surfaces(new, found, surfaces)
        for part, own, surface in zip(new, found, surfaces):
            self.ids[part] = ",".join(map(str, own))
            if surface != part.replace(MARK, " "):
                self.surfaces[part] = surface

    def _check_surfaces(self, parts: list[str], found: list[list[int]], surfaces: list[str]) -> None:
        """Behind a line feed no space is taken off, so all parts can be decoded as one text."""
        if self.library.decode(self.head + list(itertools.chain.from_iterable(found))) == "\n" + "".join(surfaces):
            return
        for part, own, surface in zip(parts, found, surfaces):
            other = self.library.decode(self.head + own)
            if other != "\n" + surface:
                raise AssertionError(f"decoding of {part!r} differs from the library: {surface!r}, {other!r}")
        raise AssertionError("decoding of joined parts differs from the library")

    def rows(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Ids joined by commas, and the decoded text, of each text."""
        split = [self.vocabulary.split(t) for t in texts]
        self.learn(set().union(*split))
        for parts in split:
            if self.surfaces.keys().isdisjoint(parts):
                whole = "".join(parts).replace(MARK, " ")
            else:
                whole = "".join([self.surfaces[p] if p in self.surfaces else p.replace(MARK, " ") for p in parts])
            yield ",".join(map(self.ids.__getitem__, parts)), _unprefixed(whole)


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_SHARED: dict[bytes, CheckedParts] = {}


def shared_parts(path: str) -> CheckedParts:
    """The table of this Python worker; another model replaces it."""
    key = hashlib.sha256(_read(path)).digest()
    if key not in _SHARED:
        _SHARED.clear()
        _SHARED[key] = CheckedParts(path)
    return _SHARED[key]


def _portions(batch: pa.RecordBatch, rows: int = 256, characters: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with few rows and, unless one row alone has more, few characters."""
    sizes, start, held = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), 0, 0
    for at, size in enumerate(sizes):
        if at > start and (at - start == rows or held + size > characters):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)


def encode_documents(df: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep_ids`` also ids and decoded; and the columns to ``carry``."""
    source = df.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"), *[F.col(f"`{c}`") for c in carry])
    fields = [source.schema["doc_id"]]
    schema = f"doc_id {fields[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"
    for c in carry:
        schema += f", `{c}` {source.schema[c].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from rowloom.llm.pieces import shared_parts  # of the worker's module, which outlives the task

        parts = shared_parts(model)
        for batch in batches:
            for piece in _portions(batch):
                n, sha, back, ids, decoded = [], [], [], [], []
                for joined, whole in parts.rows(piece.column(1).to_pylist()):
                    n.append(joined.count(",") + 1 if joined else 0)
                    sha.append(hashlib.sha256(joined.encode()).hexdigest())
                    back.append(hashlib.sha256(whole.encode("utf-8")).hexdigest())
                    if keep_ids:
                        ids.append([int(i) for i in joined.split(",")] if joined else [])
                        decoded.append(whole)
                out = [piece.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    out += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                out += [piece.column(2 + i) for i in range(len(carry))]
                names += carry
                yield pa.RecordBatch.from_arrays(out, names=names)

    return source.mapInArrow(run, schema)
