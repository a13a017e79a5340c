"""Byte-level BPE by a transducer that is made as it is used, and decoding as a stream.

Merges by rank have a property that makes them a finite-state matter: tokens follow each other in the encoding of a text if
and only if every two neighbours stay as they are when the bytes of just these two are encoded, and every text has one such
sequence.  So a nondeterministic transducer reads bytes along the tokens, guesses where each ends, and goes on from there
only with neighbours that are stable.  Its determinised states are sets of such guesses; they and their arcs are made when a
text first needs them.  Tokens that all guesses share are emitted; how many wait is bounded, as guesses that disagree span
no more than the longest token and die out.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import pieces as runs
from ._text import utf8

#: States, stable or unstable neighbours, and words whose ids a worker keeps; a table that is full is begun anew.
MOST_STATES, MOST_PAIRS, MOST_WORDS, LONG_WORD = 200_000, 500_000, 300_000, 64
#: Characters of a text that is split at once, matches that a longer one is split into at a time, and ids decoded at once.
AT_ONCE, MATCHES, IDS = 1 << 20, 1 << 16, 1 << 16
NEVER = 1 << 62


class Merges:
    """A rank file: tokens by rank, and which of them stay apart as neighbours."""

    def __init__(self, path: str):
        self.rank: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    self.rank[base64.b64decode(token)] = int(rank)
        self.token = {r: t for t, r in self.rank.items()}
        if not all(bytes([b]) in self.rank for b in range(256)):
            raise ValueError("every byte has to be a token")
        #: Tokens that are one together, by both; and the halves of tokens that are so in one way only.
        self.joined: dict[int, int] = {}
        self._halves: dict[int, list[int]] = {}
        for raw, rank in self.rank.items():
            ways = [[a, b] for i in range(1, len(raw)) if (a := self.rank.get(raw[:i])) is not None and (b := self.rank.get(raw[i:])) is not None]
            self.joined.update((a << 32 | b, rank) for a, b in ways)
            if len(ways) == 1:
                self._halves[rank] = ways[0]
        self._spines: dict[tuple[int, int], list[int]] = {}
        self._pairs: dict[int, bool] = {}

    def merged(self, raw: bytes, parts: int = 1) -> list[int]:
        """The ranks that ``raw`` has once no neighbours are a token together, or ``parts`` are left: the lowest rank first, and
        of equal ones the leftmost.  For tokens, which are short."""
        now = [raw[i : i + 1] for i in range(len(raw))]
        while len(now) > parts:
            best = min((self.rank.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(now, now[1:], strict=False)))
            if best[0] == NEVER:
                break
            now[best[1] : best[1] + 2] = [now[best[1]] + now[best[1] + 1]]
        return [self.rank[t] for t in now]

    def spine(self, token: int, side: int) -> list[int]:
        """What the last (side 1) or first (0) byte of a token becomes by its merges, in turn, the token last, and ``NEVER``."""
        found = self._spines.get((token, side))
        if found is None:
            raw = self.token[token]
            if len(raw) == 1:
                found = [token, NEVER]
            else:
                halves = self._halves.get(token) or self.merged(raw, 2)
                if len(halves) != 2 or max(halves) >= token:
                    raise ValueError(f"token {token} isn't made of tokens of lower ranks")
                found = [*self.spine(halves[side], side)[:-1], token, NEVER]
            self._spines[token, side] = found
        return found

    def stable(self, a: int, b: int) -> bool:
        """Whether two tokens next to each other are encoded as these two: no merge over the border comes before those that
        build either side."""
        found = self._pairs.get(a << 32 | b)
        if found is None:
            left, right = self.spine(a, 1), self.spine(b, 0)
            i = j = 1
            x, next_x, y, next_y = left[0], left[1], right[0], right[1]
            while True:
                over = self.joined.get(x << 32 | y, NEVER)
                if over < next_x and over <= next_y:  # of equal ranks the leftmost merge comes first
                    found = False
                    break
                if next_x <= next_y:
                    if next_x == NEVER:
                        found = True
                        break
                    i += 1
                    x, next_x = next_x, left[i]
                else:
                    j += 1
                    y, next_y = next_y, right[j]
            if len(self._pairs) >= MOST_PAIRS:
                self._pairs.clear()
            self._pairs[a << 32 | b] = found
        return found


class Transducer:
    """From bytes to tokens.  A state is the token emitted last (-1: none) and the guesses, those of longer tokens first: for each
    the place in the tree of tokens that the bytes since its last token lead to (0: the root), times 256, and its tokens that
    wait."""

    def __init__(self, merges: Merges):
        self.stable = merges.stable
        self.next: dict[int, int] = {}
        self.token, self.deeper = [-1], [True]
        for raw, rank in merges.rank.items():
            node = 0
            for byte in raw:
                self.deeper[node] = True
                arc = node << 8 | byte
                if arc not in self.next:
                    self.next[arc] = len(self.token)
                    self.token.append(-1)
                    self.deeper.append(False)
                node = self.next[arc]
            self.token[node] = rank
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.arcs: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._state((-1, (0, ())))

    def _state(self, key: tuple) -> int:
        found = self.number.get(key)
        if found is None:
            if len(self.states) >= MOST_STATES:
                for table in (self.states, self.number, self.arcs):
                    table.clear()
                self._state((-1, (0, ())))
            found = self.number[key] = len(self.states)
            self.states.append(key)
        return found

    def arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after a byte and the tokens that are certain by then."""
        key = self.states[state]
        last, new, whole = key[0], [], None
        follow, deeper, tokens = self.next.get, self.deeper, self.token
        for place, wait in key[1:]:
            node = follow(place | byte)
            if node is None:
                continue
            if deeper[node]:
                new.append((node << 8, wait))
            if whole is None and tokens[node] >= 0:  # of every text there is one sequence
                before = wait[-1] if wait else last
                if before < 0 or self.stable(before, tokens[node]):
                    whole = (*wait, tokens[node])
        if whole is None:
            raise ValueError("the tokens of a text aren't told by their neighbours")
        new.append((0, whole))
        sure = ()
        if new[0][1]:  # else nothing is certain
            n = min(len(wait) for _, wait in new)
            while any(wait[:n] != whole[:n] for _, wait in new):
                n -= 1
            sure = whole[:n]
            if sure:
                last, new = sure[-1], [(place, wait[n:]) for place, wait in new]
        to = self._state((last, *new))
        if state < len(self.states) and self.states[state] is key:  # else the tables are new
            self.arcs[state << 8 | byte] = to, sure
        return to, sure

    def encode(self, raw: bytes) -> list[int]:
        out: list[int] = []
        state, arcs = 0, self.arcs
        for byte in raw:
            found = arcs.get(state << 8 | byte)
            if found is None:
                found = self.arc(state, byte)
            state = found[0]
            if found[1]:
                out += found[1]
        out += self.states[state][-1][1]  # the last guess has a whole token at the end
        return out


class _Words(dict):
    """Ids of matches of the pattern as little-endian bytes; a match that is long or new goes through the transducer.  A full
    table becomes the earlier one, from which words that come again are taken over."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer
        self.earlier: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.earlier.get(word)
        if ids is None:
            found = self.transducer.encode(word.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(word) <= LONG_WORD:
            if len(self) >= MOST_WORDS:
                self.earlier = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Utf8:
    """UTF-8 that comes in pieces: an incremental machine that gives the characters which are complete and holds back the bytes
    of one that may go on.  What can't become a character is U+FFFD, as when the whole is decoded at once."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def _step(state: tuple[int, int, int] | None, byte: int) -> tuple[int, int, int] | None:
        """(bytes to come, least, largest next one) after a byte; None where no character is open."""
        if state is None:
            if 0xC2 <= byte <= 0xDF:
                return 1, 0x80, 0xBF
            if 0xE0 <= byte <= 0xEF:
                return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
            if 0xF0 <= byte <= 0xF4:
                return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
            return None
        more, low, high = state
        return (more - 1, 0x80, 0xBF) if more > 1 and low <= byte <= high else None

    def feed(self, raw: bytes) -> str:
        raw = self.held + raw
        at = len(raw)
        for k in range(1, min(3, len(raw)) + 1):  # an open character begins with the last byte that begins any
            if raw[-k] & 0xC0 != 0x80:
                state = None
                for i, byte in enumerate(raw[-k:]):
                    state = self._step(state, byte)
                    if state is None or i == 0 and byte < 0xC0:
                        break
                at -= k if state is not None else 0
                break
        self.held = raw[at:]
        return raw[:at].decode("utf-8", "replace")

    def close(self) -> str:
        raw, self.held = self.held, b""
        return raw.decode("utf-8", "replace")


class Coder:
    """A rank file and a pattern as encoder and decoder."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.merges = Merges(path)
        self.words = _Words(Transducer(self.merges))
        self.pattern = regex.compile(pattern)
        self.table = [self.merges.token.get(i, b"") for i in range(max(self.merges.token) + 1)]

    def encode(self, text: str) -> bytes:
        """Ids of a text, four little-endian bytes each."""
        ids = self.words.__getitem__
        if len(text) <= AT_ONCE:
            return b"".join(map(ids, self.pattern.findall(text)))
        found = (m.group() for m in self.pattern.finditer(text))
        out = bytearray()
        while part := list(islice(found, MATCHES)):
            out += b"".join(map(ids, part))
        return bytes(out)

    def stream(self, ids: np.ndarray) -> Iterator[str]:
        """The text of the ids, piece by piece; an id that no token has stands for nothing."""
        text, size = Utf8(), len(self.table)
        for a in range(0, len(ids), IDS):
            yield text.feed(b"".join([self.table[i] for i in ids[a : a + IDS].tolist() if 0 <= i < size]))
        yield text.close()

    def decode(self, ids: np.ndarray) -> str:
        return "".join(self.stream(ids))


@lru_cache(2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def encode(docs: DataFrame, ranks: str, pattern: str, *, packed: bool = False, decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids`` of ``text``, each match of ``pattern`` encoded by itself, without special tokens: an array, or
    if ``packed`` the ids as little-endian bytes, four each; and, if asked for, ``decoded``, the text that the ids decode to.

    A null text counts as an empty one, which has no ids.  Texts are encoded whole, however long.  Other columns pass
    through; columns of those names are replaced.  ``ranks`` is the path of a rank file, which executors read.
    """
    docs = docs.drop("ids", *(["decoded"] if decoded else []))
    schema = T.StructType([*docs.schema, T.StructField("ids", T.BinaryType() if packed else T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ranks, pattern)
        for batch in batches:
            text = batch.column("text").cast(pa.string())
            _, offsets = utf8(text)
            for a, b in runs(offsets):
                ids = [c.encode(t or "") for t in text.slice(a, b - a).to_pylist()]
                columns = [*batch.slice(a, b - a).columns, pa.array(ids, pa.binary()) if packed else _lists(ids)]
                if decoded:
                    columns.append(pa.array([c.decode(np.frombuffer(i, "<u4")) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def _lists(ids: list[bytes]) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def decode(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids``, an array or packed; bytes that are no text are U+FFFD, null ids and ids that
    no token has stand for nothing."""
    rows = rows.drop("decoded")
    schema = T.StructType([*rows.schema, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ranks, pattern)
        for batch in batches:
            found = []
            for ids in batch.column("ids"):
                if not ids.is_valid:
                    found.append("")
                elif pa.types.is_binary(ids.type):
                    found.append(c.decode(np.frombuffer(ids.as_buffer(), "<u4")))
                else:
                    found.append(c.decode(np.array([i for i in ids.as_py() if i is not None], np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def public_ranks() -> tuple[str, str]:
    """Rank file and pattern of the query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents' texts and what they decode to, as counts and digests; a null text counts as an empty one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = encode(docs, *public_ranks(), packed=True, decoded=True)
    return rows.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op11_byte_bpe": op11_byte_bpe}
