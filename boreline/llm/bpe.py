"""BPE encoding and decoding as streaming transducers.

``lookahead`` computes from the merge list how many bytes behind the end of
what has been read a token can still change. ``Encoder`` reads a text in
pieces, emits a token as soon as that many bytes follow it, and drops what it
has emitted, so its memory does not grow with the text. ``Decoder`` turns ids
back into text with the state of one unfinished character.

Why the bound holds: text that is added on the right changes the symbols left
of it only through merges. The place up to which both runs agree moves left
when a rule (a, b) fires in one run and not in the other, by the length of a;
b starts at that place. What moves it again fires later. Rules of one rank
fire from the left, so the later rule has a higher rank, and its right side
starts with a, or with a symbol built on a. The heaviest such chain of rules
bounds the whole way.

A vocabulary is read from a tokenizer file whose path is a parameter. Files
with a normaliser, or with added tokens that strip their surroundings, are
refused: their result would differ from the library's.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from array import array
from functools import lru_cache

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boreline.llm.rows import map_rows, text_of

#: Characters of a text that are read at once.
CHUNK = 1 << 16
#: Units and pre-tokens kept with their ids in one Python worker; beyond it new ones are encoded each time.
CACHED_UNITS, CACHED_PIECES = 160_000, 60_000
#: Longer pre-tokens are streamed byte-wise instead of kept.
LONG_PIECE = 512
#: Up to so many bytes, merges are found by scanning.
SHORT_PIECE = 24

# The pre-token pattern of byte-level BPE, white space beside a space, and the classes of running characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FIND = regex.compile(PATTERN).findall
SPACES = re.compile(r" \s|\s ").search
RUNS = [regex.compile(r) for r in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks, token bytes and added tokens of one tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        if not plain or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError("only plain byte-level BPE files are supported")
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens", ())}
        if any(a[k] for a in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that look at their surroundings are not supported")
        alphabet = byte_alphabet()
        ids = model["vocab"]
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in ids.items() if all(c in alphabet for c in token)}
        self.bytes_of |= {i: content.encode() for content, i in self.added.items()}
        self.id_of_byte = [ids.get(c, -1) for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.ranks = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.made = [made for _, made in self.merges.values()]
        self.lookahead = lookahead(self)
        self.added_pattern = regex.compile("|".join(regex.escape(a) for a in sorted(self.added, key=len, reverse=True))) if self.added else None
        #: Characters at the end of the input whose pre-token, or added token, may go on.
        self.hold = 2 + max([0, *map(len, self.added)])


def lookahead(vocabulary: Vocabulary) -> int:
    """Bytes after a token that fix it, from the heaviest chain of rules (see above)."""
    ordered = sorted(((rank, pair, made) for pair, (rank, made) in vocabulary.merges.items()), reverse=True)
    lefts: dict[int, set[int]] = {}
    for _, (left, _), made in reversed(ordered):
        lefts.setdefault(made, set()).update({left} | lefts.get(left, set()))
    size = {i: len(b) for i, b in vocabulary.bytes_of.items()}
    best: dict[int, int] = {}
    most = 0
    for _, (left, right), _ in ordered:
        reach = size[left] + best.get(left, 0)
        most = max(most, reach)
        for start in (right, *lefts.get(right, ())):
            if best.get(start, 0) < reach:
                best[start] = reach
    return most


def merge(vocabulary: Vocabulary, piece: bytes) -> list[int]:
    """All merges of one piece, lowest rank first and from the left."""
    ids = [vocabulary.id_of_byte[b] for b in piece]
    merges = vocabulary.merges
    n = len(ids)
    if n <= SHORT_PIECE:  # scanning beats a heap here
        known, none = vocabulary.ranks.get, len(vocabulary.made)
        ranks = [known(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            ids[k] = made = vocabulary.made[least]
            del ids[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = known((made, ids[k + 1]), none)
            if k:
                ranks[k - 1] = known((ids[k - 1], made), none)
        return ids
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(found[0], k, found[1], ids[k], ids[k + 1]) for k in range(n - 1) if (found := merges.get((ids[k], ids[k + 1])))]
    heapq.heapify(heap)
    while heap:
        _, k, made, left, right = heapq.heappop(heap)
        nxt = after[k]
        if ids[k] != left or nxt >= n or ids[nxt] != right:
            continue
        ids[k], ids[nxt] = made, -1
        after[k] = after[nxt]
        if after[k] < n:
            before[after[k]] = k
            if found := merges.get((made, ids[after[k]])):
                heapq.heappush(heap, (found[0], k, found[1], made, ids[after[k]]))
        if before[k] >= 0 and (found := merges.get((ids[before[k]], made))):
            heapq.heappush(heap, (found[0], before[k], found[1], ids[before[k]], made))
    return [i for i in ids if i >= 0]


class PieceStream:
    """The bytes of one pre-token, fed in parts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.window = 4 * vocabulary.lookahead + 1024
        self.held = b""

    def feed(self, data: bytes, out: list[bytes]) -> None:
        for start in range(0, len(data), self.window):
            self.held += data[start : start + self.window]
            if len(self.held) < self.window:
                return
            stable, done, ids = len(self.held) - self.vocabulary.lookahead, 0, array("I")
            for i in merge(self.vocabulary, self.held):
                end = done + len(self.vocabulary.bytes_of[i])
                if end > stable:
                    break
                ids.append(i)
                done = end
            out.append(ids.tobytes())
            self.held = self.held[done:]

    def finish(self, out: list[bytes]) -> None:
        out.append(array("I", merge(self.vocabulary, self.held)).tobytes())
        self.held = b""


class Pieces(dict):
    """Ids of the pre-tokens seen, as packed integers, up to a fixed number of them."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > LONG_PIECE:
            out: list[bytes] = []
            stream = PieceStream(self.vocabulary)
            stream.feed(piece.encode(), out)
            stream.finish(out)
            return b"".join(out)
        packed = array("I", merge(self.vocabulary, piece.encode())).tobytes()
        if len(self) < CACHED_PIECES:
            self[piece] = packed
        return packed


class Units(dict):
    """Ids of what stands between two single spaces, with the space before it."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.split = pieces, FIND

    def __missing__(self, unit: str) -> bytes:
        packed = b"".join(map(self.pieces.__getitem__, self.split(" " + unit)))
        if len(self) < CACHED_UNITS and len(unit) <= LONG_PIECE:
            self[unit] = packed
        return packed


class Encoder:
    """Text in parts to ids; ``feed`` returns what is certain, ``finish`` the rest."""

    def __init__(self, vocabulary: Vocabulary, units: Units | None = None):
        self.vocabulary = vocabulary
        self.units = Units(Pieces(vocabulary)) if units is None else units
        self.pieces, self.split = self.units.pieces, self.units.split
        self.tail = ""
        self.run = None

    def feed(self, text: str) -> array:
        out: list[bytes] = []
        self.tail += text
        self._added(out)
        self._take(out, len(self.tail) - self.vocabulary.hold)
        return array("I", b"".join(out))

    def finish(self) -> array:
        out: list[bytes] = []
        self._added(out)
        self._end(out)
        return array("I", b"".join(out))

    def _added(self, out: list[bytes]) -> None:
        pattern = self.vocabulary.added_pattern
        while pattern and (found := pattern.search(self.tail)):
            rest = self.tail[found.end() :]
            self.tail = self.tail[: found.start()]
            self._end(out)
            out.append(array("I", [self.vocabulary.added[found[0]]]).tobytes())
            self.tail = rest

    def _leave(self, out: list[bytes], kind: regex.Pattern, stream: PieceStream, end: int) -> None:
        """The long pre-token ends here; of white space before something else the last stays in the tail."""
        if kind is RUNS[3] and 0 < end < len(self.tail):
            end -= 1
        stream.feed(self.tail[:end].encode(), out)
        stream.finish(out)
        self.tail, self.run = self.tail[end:], None

    def _end(self, out: list[bytes]) -> None:
        """Nothing follows the tail."""
        if self.run:
            found = self.run[0].match(self.tail)
            self._leave(out, *self.run, found.end() if found else 0)
        self._spaced(out, len(self.tail))
        out.extend(map(self.pieces.__getitem__, self.split(self.tail)))
        self.tail = ""

    def _spaced(self, out: list[bytes], certain: int) -> None:
        """The tail up to its last single space: a pre-token starts at each of those."""
        cut = self.tail.rfind(" ", 1, max(1, certain - 1))
        if cut < 1 or SPACES(self.tail, cut - 1, cut + 2):
            return
        head = self.tail[:cut]
        if SPACES(head):
            return
        first, *others = head.split(" ")
        out.extend(map(self.pieces.__getitem__, self.split(first)))
        out.extend(map(self.units.__getitem__, others))
        self.tail = self.tail[cut:]

    def _take(self, out: list[bytes], certain: int) -> None:
        """Pre-tokens that end by ``certain``, and all but the end of one that goes on for long."""
        if self.run:
            kind, stream = self.run
            found = kind.match(self.tail)
            end = found.end() if found else 0
            if end > certain:  # goes on: the end is held, for a white space may belong to what follows
                stream.feed(self.tail[: max(0, certain)].encode(), out)
                self.tail = self.tail[max(0, certain) :]
                return
            before = len(self.tail)
            self._leave(out, kind, stream, end)
            certain -= before - len(self.tail)
        before = len(self.tail)
        self._spaced(out, certain)
        certain -= before - len(self.tail)
        pieces, end = self.split(self.tail), len(self.tail)
        while pieces and end > certain:
            end -= len(pieces.pop())
        out.extend(map(self.pieces.__getitem__, pieces))
        self.tail = self.tail[end:]
        if len(self.tail) > CHUNK:
            kind = next(r for r in RUNS if r.match(self.tail[1:2]))
            self.run = (kind, PieceStream(self.vocabulary))
            first = self.tail[: -self.vocabulary.hold]
            self.run[1].feed(first.encode(), out)
            self.tail = self.tail[len(first) :]


class Decoder:
    """Ids in parts to text; bytes that are no text become U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = vocabulary.bytes_of.__getitem__
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.state.decode(b"".join(map(self.bytes_of, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


@lru_cache(maxsize=2)
def units_of(content: str) -> Units:
    """One per Python worker, which serves many tasks."""
    return Units(Pieces(Vocabulary(content)))


def encode_decode(df: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode every text and decode it again.

    Returns one row per input row: the key, ``n_tokens``, ``ids_sha256`` (ids
    as little-endian unsigned 32-bit integers), ``decoded_sha256`` (UTF-8),
    and with ``keep_ids`` also ``ids``. Null and empty texts give no tokens;
    equal rows give equal rows; other columns, whatever their names, are not
    looked at. The vocabulary file travels to the tasks as one broadcast of
    its own size; texts are read in chunks and never shuffled.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())

    def make():
        units = units_of(content.value)
        vocabulary = units.pieces.vocabulary

        def one(value: str) -> tuple:
            encoder, decoder = Encoder(vocabulary, units), Decoder(vocabulary)
            n, ids_hash, text_hash, kept = 0, hashlib.sha256(), hashlib.sha256(), array("I")
            parts = [value[k : k + CHUNK] for k in range(0, len(value), CHUNK)]
            for part in (*parts, None):
                ids = encoder.finish() if part is None else encoder.feed(part)
                n += len(ids)
                ids_hash.update(ids.tobytes())
                text_hash.update(decoder.feed(ids).encode())
                if keep_ids:
                    kept.extend(ids)
            text_hash.update(decoder.finish().encode())
            return n, ids_hash.hexdigest(), text_hash.hexdigest(), kept.tolist()

        def work(keys, texts):
            done = [one(t) for t in texts]
            return [keys, *([d[k] for d in done] for k in range(4 if keep_ids else 3))]

        return work

    kind = dict(df.dtypes)[key]
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<bigint>" * keep_ids
    return map_rows(df.select(F.col(key), text_of(text).alias("text")), schema, make)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
