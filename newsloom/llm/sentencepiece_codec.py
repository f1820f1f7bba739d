"""Encoding and decoding of whole texts with a SentencePiece BPE model, by vectorised merge rounds.

A text's blanks become the model's blank sign, with one put before it, and the text is cut into units
that no piece reaches across: before each run of blanks and around line feeds. Units seen before are
looked up in a bounded cache; all new ones of a block are encoded at once. Their characters lie in one
flat array of symbols. Units are cut again where no piece holds the two neighbouring characters. Each
round takes in every segment the smallest rank of its neighbouring pairs, merges it where it stands
leftmost in all segments at the same time, and closes up the array; finished segments leave it. Where
no piece that outranks a merged one, or equals it, begins or ends with it, all its places in a segment
merge in the same round, from the left and without overlap: then the library's order, one merge after
the other by score and place, cannot give another result. Characters without a piece become bytes.

A run of more blanks than the longest blank piece is cut into such pieces from the left, which is what
the merges of equally good pairs, leftmost first, come to; models where they do not are refused, like
models of another kind, with a normalisation of their own or without byte pieces.

NULL is read as the empty text, which has the begin and end id only; the sign that stands for a blank is
decoded as a blank, as the library does. Texts of any length are worked on in blocks of `BLOCK_CHARS`
characters, cut before blanks; a single unit is never cut. Repeated rows are encoded each for itself, an empty table stays
empty. Columns named like the outputs are replaced, whatever their case, all others kept.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, fresh, whole_text

BLANK = "▁"
BLOCK_CHARS = 1 << 20
CACHED_UNITS = 300_000
CACHED_LENGTH = 48
NO_PAIR = np.int32(np.iinfo(np.int32).max)

_UNITS = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n")
_BEFORE_BLANKS = re.compile(f"(?<=[^{BLANK}])(?={BLANK})")

codecs.register_error("newsloom_each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    """A model's tables, made ready for merge rounds; `encode` and `decode` are those of the library."""

    def __init__(self, model: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        read = proto.ModelProto()
        with open(model, "rb") as file:
            read.ParseFromString(file.read())
        kinds, norm = proto.ModelProto.SentencePiece, read.normalizer_spec
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        if read.trainer_spec.model_type != proto.TrainerSpec.BPE or not read.trainer_spec.byte_fallback or not plain or read.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte pieces, a leading blank and no normalisation can be used")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in read.pieces):
            raise ValueError("models with user-defined or unused pieces cannot be used")
        ids = {p.piece: n for n, p in enumerate(read.pieces) if p.type == kinds.NORMAL}
        scores = {p.piece: p.score for p in read.pieces if p.type == kinds.NORMAL}
        self.first_byte = next(n for n, p in enumerate(read.pieces) if p.type == kinds.BYTE)
        self.begin, self.end = read.trainer_spec.bos_id, read.trainer_spec.eos_id
        self._check(scores)
        self._symbols(ids, scores)
        self.shown = [self._surface(n, p, kinds, read.trainer_spec.unk_surface) for n, p in enumerate(read.pieces)]
        self.leading = {n for n, p in enumerate(read.pieces) if p.type == kinds.NORMAL and p.piece.startswith(BLANK)}
        self.silent = {n for n, p in enumerate(read.pieces) if p.type == kinds.CONTROL}
        self.cache: dict[str, bytes] = {"": b""}

    @staticmethod
    def _check(scores: dict[str, float]) -> None:
        """The cuts into units need: no piece with a blank behind another sign, none with two blanks and a sign, none with a line feed."""
        blanks = {p: s for p, s in scores.items() if not p.strip(BLANK)}
        others = [p for p in scores if p not in blanks and len(p) > 1]
        lowest = min((scores[p] for p in others), default=0.0)
        runs = [s for p, s in blanks.items() if len(p) > 1]
        if any(BLANK in p[1:] or "\n" in p for p in others) or len(set(runs)) > 1 or any(s >= lowest for s in runs):
            raise ValueError("pieces across blanks or line feeds cannot be used")

    def _surface(self, number: int, piece, kinds, unknown: str) -> bytes:
        if piece.type == kinds.CONTROL:
            return b""
        if piece.type == kinds.UNKNOWN:
            return unknown.encode()
        if piece.type == kinds.BYTE:
            return bytes([number - self.first_byte])
        return piece.piece.replace(BLANK, " ").encode()

    def _symbols(self, ids: dict[str, int], scores: dict[str, float]) -> None:
        """Symbols are pieces and the characters in them; a pair of symbols that makes a piece has its rank."""
        singles = sorted({c for p in ids for c in p})
        names = list(dict.fromkeys([*singles, *ids]))
        number = {name: n for n, name in enumerate(names)}
        self.count = len(names)
        ranks = {s: n for n, s in enumerate(sorted({scores[p] for p in ids if len(p) > 1}, reverse=True))}
        pairs, safe = {}, np.ones(len(ranks) + 1, dtype=bool)
        for piece in ids:
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in number and right in number:
                    pairs[number[left] * self.count + number[right]] = (ranks[scores[piece]], number[piece])
                for part in (left, right):
                    if len(part) > 1 and part in scores and scores[part] <= scores[piece]:
                        safe[ranks[scores[part]]] = False
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        found = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32).reshape(-1, 2)
        self.rank, self.made, self.safe = found[:, 0].copy(), found[:, 1].copy(), safe
        self.neighbours = np.array(sorted({(ord(a) << 21) | ord(b) for p in ids for a, b in zip(p, p[1:])}), dtype=np.int64)
        # Characters outside all pieces get numbers behind the symbols, by their code point.
        self.symbol = np.arange(self.count, self.count + 0x110000, dtype=np.int32)
        self.symbol[[ord(c) for c in singles]] = [number[c] for c in singles]
        self.written = [self._ids(name, ids.get(name)) for name in names]
        longest = max((len(p) for p in ids if not p.strip(BLANK)), default=1)
        self.longest_run = longest
        if longest > 1:
            run, whole = self._encode_units([BLANK * longest])[0], np.array([ids[BLANK * longest]], dtype="<u4").tobytes()
            if run != whole:
                raise ValueError("runs of blanks of this model cannot be cut")

    def _ids(self, name: str, own: int | None) -> bytes:
        numbers = [self.first_byte + b for b in name.encode()] if own is None else [own]
        return np.array(numbers, dtype="<u4").tobytes()

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and outcome of each pair; NO_PAIR where it makes no piece."""
        rank, made = np.full(len(left), NO_PAIR, dtype=np.int32), np.zeros(len(left), dtype=np.int32)
        keys = left.astype(np.int64) * self.count + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        hit = (left < self.count) & (right < self.count) & (self.keys[at] == keys) if len(self.keys) else np.zeros(len(left), dtype=bool)
        rank[hit], made[hit] = self.rank[at[hit]], self.made[at[hit]]
        return rank, made

    def _segments(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The segment of each character: a new one at each unit and where no piece holds both neighbours."""
        fresh_start = np.ones(len(codes), dtype=bool)
        keys = (codes[:-1].astype(np.int64) << 21) | codes[1:]
        at = np.searchsorted(self.neighbours, keys)
        at[at == len(self.neighbours)] = 0
        fresh_start[1:] = self.neighbours[at] != keys if len(self.neighbours) else True
        fresh_start[first] = True
        return np.cumsum(fresh_start)

    def _rounds(self, symbols: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The symbols that are left at each place when no pair remains, -1 where a symbol was merged into its left one."""
        left_over = np.full(len(symbols), -1, dtype=np.int32)
        place = np.arange(len(symbols))
        rank, made = self._pairs(symbols, np.append(symbols[1:], symbols[:1]))
        rank[np.append(segment[1:] != segment[:-1], True)] = NO_PAIR
        while len(symbols):
            first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            sizes = np.diff(np.append(first, len(symbols)))
            best = np.minimum.reduceat(rank, first)
            ended = best == NO_PAIR
            if ended.any():
                gone = np.repeat(ended, sizes)
                left_over[place[gone]] = symbols[gone]
                stay = ~gone
                symbols, segment, place, rank, made = (x[stay] for x in (symbols, segment, place, rank, made))
                best, sizes = best[~ended], sizes[~ended]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            run = np.append(True, hits[1:] != hits[:-1] + 1)
            offset = hits - np.maximum.accumulate(np.where(run, hits, 0))
            leftmost = np.append(True, segment[hits[1:]] != segment[hits[:-1]])
            merge = hits[(offset % 2 == 0) & (self.safe[rank[hits]] | leftmost)]
            symbols[merge] = made[merge]
            stay = np.ones(len(symbols), dtype=bool)
            stay[merge + 1] = False
            symbols, segment, place, rank, made = (x[stay] for x in (symbols, segment, place, rank, made))
            at = merge - np.arange(len(merge))
            touched = np.zeros(len(symbols), dtype=bool)
            touched[at] = touched[at[at > 0] - 1] = True
            rank[touched] = NO_PAIR
            inner = np.flatnonzero(touched[:-1])
            inner = inner[segment[inner] == segment[inner + 1]]
            rank[inner], made[inner] = self._pairs(symbols[inner], symbols[inner + 1])
        return left_over

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of each unit, all by the same rounds."""
        codes = np.frombuffer("".join(units).encode("utf-32-le"), dtype="<u4").astype(np.int32)
        sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        first = np.cumsum(sizes) - sizes
        left = self._rounds(self.symbol[codes], self._segments(codes, first))
        alive = left >= 0
        ends = np.cumsum(np.add.reduceat(alive, first)).tolist() if len(units) else []
        written, count = self.written, self.count
        ids = [written[s] if s < count else self._ids(chr(s - count), None) for s in left[alive].tolist()]
        begins = [0, *ends[:-1]]
        return [b"".join(ids[a:b]) for a, b in zip(begins, ends)]

    def _encode_new(self, units: list[str]) -> dict[str, bytes]:
        """Ids by unit; blanks beyond the longest blank piece are cut off in whole such pieces first."""
        short, parts = {}, {}
        for unit in units:
            word = unit.lstrip(BLANK)
            run = len(unit) - len(word)
            if run > self.longest_run:
                tied = BLANK + word
                parts[unit] = (run, tied)
                short[tied] = b""
            else:
                short[unit] = b""
        names = list(short)
        short = dict(zip(names, self._encode_units(names)))
        if parts:
            lone, longest = self._ids(BLANK, self.piece(BLANK)), self.longest_run
            rests = [BLANK * n for n in range(1, longest + 1)]
            runs = dict(enumerate([b"", *self._encode_units(rests)]))
            for unit, (run, tied) in parts.items():
                ids = short[tied]
                free = run if ids[:4] == lone else run - 1
                rest = ids[4:] if ids[:4] == lone else ids
                short[unit] = runs[longest] * (free // longest) + runs[free % longest] + rest
        return short

    def piece(self, name: str) -> int | None:
        """The id of a one-character piece."""
        ids = np.frombuffer(self.written[self.symbol[ord(name)]], dtype="<u4")
        return int(ids[0]) if len(ids) == 1 else None

    def encode_blocks(self, blocks: list[str]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit numbers, of escaped blocks that begin with a blank sign."""
        cut = [_UNITS.findall(b) if BLANK * 2 in b else b.replace(BLANK, " " + BLANK).replace("\n", " \n ").split(" ") for b in blocks]
        distinct = set().union(*cut)
        new = distinct.difference(self.cache)
        if len(self.cache) + len(new) > CACHED_UNITS and 2 * len(new) > len(distinct):
            self.cache = {"": b""}  # filled by other texts than these
            new = distinct - {""}
        known = self._encode_new(list(new)) if new else {}
        room = max(0, CACHED_UNITS - len(self.cache))
        self.cache.update(islice(((u, ids) for u, ids in known.items() if len(u) <= CACHED_LENGTH), room))
        known.update((u, self.cache[u]) for u in distinct if u not in new)
        return [b"".join(map(known.__getitem__, units)) for units in cut]

    def encode(self, text: str) -> list[int]:
        """All ids of a text, with begin and end."""
        ids = b"".join(self.encode_blocks([b])[0] for b in blocks_of(text))
        return [self.begin, *np.frombuffer(ids, dtype="<u4").tolist(), self.end]

    def surface(self, ids: list[int], opening: bool = True) -> bytes:
        """The bytes of ids in UTF-8; `opening`: the text begins here, so its first blank goes."""
        data = b"".join(map(self.shown.__getitem__, ids))
        if opening and data[:1] == b" " and next(n for n in ids if n not in self.silent) in self.leading:
            data = data[1:]
        return data

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; bytes that are no UTF-8 become one replacement sign each, also where a silent id parts them."""
        shown, run, opening = [], [], True
        for number in [*ids, self.begin]:
            if number not in self.silent:
                run.append(number)
            elif run:
                shown.append(self.surface(run, opening).decode("utf-8", "newsloom_each_byte"))
                run, opening = [], opening and not shown[-1] and run[0] not in self.leading
        return "".join(shown)


def blocks_of(text: str) -> Iterator[str]:
    """The escaped text, cut before blanks into blocks of about `BLOCK_CHARS` characters."""
    if not text:
        return
    escaped = BLANK + text.replace(" ", BLANK)
    at = 0
    while len(escaped) - at > BLOCK_CHARS:
        found = _BEFORE_BLANKS.search(escaped, at + BLOCK_CHARS)
        if not found:
            break
        yield escaped[at : found.start()]
        at = found.start()
    yield escaped[at:] if at else escaped


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    return Codec(model)


class _Digest:
    """Running hashes of one text's ids and of what they decode to."""

    def __init__(self, own: Codec) -> None:
        self.own, self.tokens, self.opening = own, 0, True
        self.ids, self.decoded = hashlib.sha256(), hashlib.sha256()
        self.add(np.array([own.begin], dtype="<u4").tobytes())

    def add(self, ids: bytes) -> None:
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        self.tokens += len(numbers)
        self.ids.update(ids)
        data = self.own.surface(numbers, self.opening)
        self.opening = self.opening and all(n in self.own.silent for n in numbers)
        self.decoded.update(data)

    def result(self) -> tuple[int, str, str]:
        self.add(np.array([self.own.end], dtype="<u4").tobytes())
        return self.tokens, self.ids.hexdigest(), self.decoded.hexdigest()


def digests(texts: list[str], own: Codec) -> list[tuple[int, str, str]]:
    """Number of ids, hash of the ids and hash of the decoded text, for each text; blocks of many texts are encoded at once."""
    states = [_Digest(own) for _ in texts]
    held: list[tuple[int, str]] = []
    size = 0

    def flush() -> None:
        for (n, _), ids in zip(held, own.encode_blocks([b for _, b in held])):
            states[n].add(ids)
        held.clear()

    for n, text in enumerate(texts):
        for block in blocks_of(text):
            held.append((n, block))
            size += len(block)
            if size >= BLOCK_CHARS:
                flush()
                size = 0
    flush()
    return [s.result() for s in states]


def encode(docs: DataFrame, text: str = "text", output: str = "ids", model: str | None = None) -> DataFrame:
    """`docs` with the ids of each whole text, begin and end included."""
    path = model or default_model()
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        own = codec(path)
        return pa.array([own.encode(t or "") for t in column.to_pylist()], type=pa.list_(pa.int32()))

    return docs.withColumn(output, ids(whole_text(text)))


def decode(docs: DataFrame, ids: str = "ids", output: str = "text", model: str | None = None) -> DataFrame:
    """`docs` with the text of each array of ids; NULL gives NULL."""
    path = model or default_model()
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        own = codec(path)
        return pa.array([None if x is None else own.decode(x) for x in column.to_pylist()], type=pa.string())

    return docs.withColumn(output, text(F.col(ids).cast("array<int>")))


def digest(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """`docs` with `n_tokens`, `ids_sha256` and `decoded_sha256` of each whole text, without holding the ids."""
    path = model or default_model()
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def found(column: pa.Array) -> pa.Array:
        rows = digests([t or "" for t in column.to_pylist()], codec(path))
        columns = [pa.array([r[i] for r in rows], type=k) for i, k in enumerate((pa.int64(), pa.string(), pa.string()))]
        return pa.StructArray.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256"])

    held = fresh(docs.columns, "_found")
    wide = docs.withColumn(held, found(whole_text(text)))
    return wide.withColumns({n: F.col(held)[n] for n in ("n_tokens", "ids_sha256", "decoded_sha256")}).drop(held)
