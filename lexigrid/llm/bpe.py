"""Byte-level BPE (operator 9): encoding by a lazily determinised finite-state transducer, decoding by an incremental UTF-8 machine.

A token sequence is the encoding of its bytes just when each two neighbours are (`Merges.fits`). So the encoding of every prefix of a
word has one last token, and all that the past has to say is which tokens may still be open: the transducer's state is the set of open
hypotheses, (place in the token trie, last token before it). Each step puts out the prefix's last token; which of them stay is known as
soon as all open hypotheses agree, no later than the longest token's bytes. States and transitions are made when first met and kept in
a hash table, through which all words of a block step together; a full table is emptied between blocks.

Texts are first cut into words as the vocabulary's pattern says (contractions, letters, numbers, other signs, white space).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.llm.common import blocks, fresh, quoted, utf8_parts

LOCKSTEP, MAX_STATES, BLOCK = 96, 1 << 17, 1 << 20
_NONE = -1


class Merges:
    """A vocabulary in ranks: a token is made of the pair that has its bytes, lower ranks first."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.ranks = ranks
        self.bytes = {t: b for b, t in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._left: dict[int, tuple[int, ...]] = {}
        self._right: dict[int, tuple[int, ...]] = {}
        self._fits: dict[int, bool] = {}

    def forget(self) -> None:
        """Empties what is remembered of pairs, which grows with the texts."""
        self._fits.clear()

    @classmethod
    def read(cls, blob: bytes) -> Merges:
        """Lines of base64 of a token, a blank and its rank."""
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines()) if a})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes token; None if its bytes are encoded otherwise, so that it never occurs."""
        if token not in self._halves:
            parts: list[bytes] | None = [bytes([b]) for b in self.bytes[token]]
            while parts and len(parts) > 2:
                best = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
                if best[0] == 1 << 60:
                    parts = None
                else:
                    parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            self._halves[token] = None if parts is None else (self.ranks[parts[0]], self.ranks[parts[-1]])
        return self._halves[token]

    def occurs(self, token: int) -> bool:
        return self.halves(token) is not None

    def _spine(self, token: int, side: int) -> tuple[int, ...]:
        """token, its half of this side, that one's half, ..., a byte."""
        kept = (self._left, self._right)[side]
        if token not in kept:
            out = [token]
            while len(self.bytes[out[-1]]) > 1:
                out.append(self.halves(out[-1])[side])
            kept[token] = tuple(out)
        return kept[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b together are encoded as a, b: no merge across their border comes before their own."""
        key = a << 32 | b
        known = self._fits.get(key)
        if known is None:
            known = self._fits[key] = self._fit(self._spine(a, 1), self._spine(b, 0))
        return known

    def _fit(self, right: tuple[int, ...], left: tuple[int, ...]) -> bool:
        i, j, late = len(right) - 1, len(left) - 1, 1 << 60
        while True:
            across = self.ranks.get(self.bytes[right[i]] + self.bytes[left[j]], late)
            a, b = right[i - 1] if i else late, left[j - 1] if j else late
            if across < a and across <= b:  # of equal ranks the leftmost merges first
                return False
            if a == b == late:
                return True
            if a <= b:
                i -= 1
            else:
                j -= 1


class Transducer:
    """step(state, byte) -> (state, last token of the prefix read), made when first asked for."""

    def __init__(self, merges: Merges, max_states: int = MAX_STATES):
        self.merges, self.max_states = merges, max_states
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [_NONE]
        self.depth: list[int] = [0]
        for raw, token in merges.ranks.items():
            node = 0
            for b in raw:
                below = self.children[node].get(b)
                if below is None:
                    below = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(_NONE)
                    self.depth.append(self.depth[node] + 1)
                node = below
            self.token[node] = token
        self.size = np.zeros(max(merges.bytes) + 1, np.int64)
        for raw, token in merges.ranks.items():
            self.size[token] = len(raw)
        self._tokens: dict[int, list[int]] = {}
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple[int, ...]] = []
        self.ids: dict[tuple[int, ...], int] = {}
        self.met: dict[int, tuple[int, int]] = {}
        self.alive: dict[int, bool] = {}
        self.merges.forget()
        self.filled = 0
        self._table(1 << 14)
        self._state((0,))

    def _table(self, size: int) -> None:
        old = (self.keys, self.to, self.out) if self.filled else None
        self.mask = size - 1
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.keys, self.to, self.out = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)
        if old:
            some = np.flatnonzero(old[0] >= 0)
            self._put(old[0][some], old[1][some], old[2][some])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _put(self, keys: np.ndarray, to: np.ndarray, out: np.ndarray) -> None:
        """Distinct new keys: of those that want one free slot one gets it, the rest try the next."""
        slots, rest = self._slots(keys), np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slots[rest]] < 0]
            self.keys[slots[free]] = keys[free]
            won = free[self.keys[slots[free]] == keys[free]]
            self.to[slots[won]], self.out[slots[won]] = to[won], out[won]
            rest = rest[self.keys[slots[rest]] != keys[rest]]
            slots[rest] = slots[rest] + 1 & self.mask

    def _state(self, state: tuple[int, ...]) -> int:
        known = self.ids.get(state)
        if known is None:
            known = self.ids[state] = len(self.states)
            self.states.append(state)
        return known

    def _below(self, node: int) -> list[int]:
        """The tokens below node that occur; an empty list stands for many."""
        if node not in self._tokens:
            out, todo = [], [node]
            while todo and len(todo) + len(out) < 16:
                for child in self.children[todo.pop()].values():
                    todo.append(child)
                    if self.token[child] != _NONE and self.merges.occurs(self.token[child]):
                        out.append(self.token[child])
            self._tokens[node] = [] if todo else out
        return self._tokens[node]

    def _open(self, node: int, last: int) -> bool:
        """Whether some token below node can follow last, or there are too many to tell."""
        if not self.children[node]:
            return False
        key = node << 32 | last
        known = self.alive.get(key)
        if known is None:
            below = self._below(node)
            known = self.alive[key] = not below or last == 0 or any(self.merges.fits(last - 1, t) for t in below)
        return known

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """A state holds its hypotheses as place in the trie << 32 | 1 + last token before it, or 0 at the beginning."""
        new, found = [], None
        for hypothesis in self.states[state]:
            below = self.children[hypothesis >> 32].get(byte)
            if below is None:
                continue
            last, token = hypothesis & 0xFFFFFFFF, self.token[below]
            if token != _NONE and found is None and self.merges.occurs(token) and (last == 0 or self.merges.fits(last - 1, token)):
                found = token
            if self._open(below, last):
                new.append(below << 32 | last)
        if found is None:
            raise AssertionError("a prefix without an encoding: the ranks are no merge order")
        new.append(found + 1)
        return self._state(tuple(new)), found

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        key = state << 8 | byte
        known = self.met.get(key)
        if known is None:
            known = self.met[key] = self.step(state, byte)
        return known

    def stream(self, raw: Iterable[int]) -> Iterator[int]:
        """The tokens of one word's bytes, each as soon as all open hypotheses agree on it."""
        state, read, base = 0, 0, 0
        last: dict[int, int] = {}  # by the end of the prefix; those up to base are emitted
        for byte in raw:
            state, token = self._step(state, byte)
            read += 1
            last[read] = token
            chains = [self._chain(last, base, read - self.depth[h >> 32]) for h in self.states[state]]
            for ends in zip(*chains, strict=False):
                if min(ends) != max(ends):
                    break
                yield last[ends[0]]
                for gone in range(base + 1, ends[0] + 1):
                    if gone != ends[0]:
                        last.pop(gone, None)
                base = ends[0]
        for end in self._chain(last, base, read):
            yield last[end]

    def _chain(self, last: dict[int, int], base: int, end: int) -> list[int]:
        out = []
        while end > base:
            out.append(end)
            end -= int(self.size[last[end]])
        return out[::-1]

    def _look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = self._slots(keys)
        away = np.flatnonzero(self.keys[slots] != keys)
        while len(away):
            gone = away[self.keys[slots[away]] < 0]
            if len(gone):
                new = np.unique(keys[gone])
                made = np.array([self.step(k >> 8, k & 255) for k in new.tolist()], np.int32)
                self.filled += len(new)
                grown = 2 * self.filled > self.mask
                if grown:
                    self._table(4 * self.mask + 4)
                self._put(new, made[:, 0], made[:, 1])
                if grown:
                    slots = self._slots(keys)
                    away = np.flatnonzero(self.keys[slots] != keys)
                    continue
            away = away[self.keys[slots[away]] != keys[away]]
            slots[away] = slots[away] + 1 & self.mask
            away = away[self.keys[slots[away]] != keys[away]]
        return self.to[slots], self.out[slots]

    def words(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' tokens, one after the other, and the place of each token's last byte."""
        if len(self.states) > self.max_states:
            self.clear()
        found = np.zeros(len(data), np.int32)
        short = np.flatnonzero(lens <= LOCKSTEP)
        order = short[np.argsort(-lens[short].astype(np.int16), kind="stable")]
        first, size = starts[order], lens[order]
        longest = int(size[0]) if len(size) else 0
        active = len(size) - np.searchsorted(size[::-1], np.arange(longest), "right")
        state = np.zeros(len(order), np.int64)
        for p in range(longest):
            m = int(active[p])
            at = first[:m] + p
            to, found[at] = self._look(state[:m] << 8 | data[at])
            state[:m] = to
        for w in np.flatnonzero(lens > LOCKSTEP).tolist():
            now, own = 0, []
            for byte in data[starts[w] : starts[w] + lens[w]].tobytes():
                now, token = self._step(now, byte)
                own.append(token)
            found[starts[w] : starts[w] + lens[w]] = own
        ends = np.zeros(len(data), bool)
        at, left = starts + lens - 1, starts
        while len(at):
            ends[at] = True
            at = at - self.size[found[at]]
            more = at >= left
            at, left = at[more], left[more]
        place = np.flatnonzero(ends)
        return found[place], place


_LETTER, _NUMBER, _BLANK, _OTHER = range(4)


@lru_cache(1)
def _classes() -> np.ndarray:
    import regex

    signs = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_BLANK, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, signs):
            a, b = m.span()
            out[[c + 0x800 * (c >= 0xD800) for c in range(a, b)]] = kind
    return out


def cut(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts and lengths of the words of texts that end at ends."""
    char = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(char)
    if not n:
        z = np.empty(0, np.int64)
        return z, z
    kind = _classes()[char]
    byte = np.flatnonzero((data & 0xC0) != 0x80)  # where each character begins
    place = np.append(byte, len(data))
    border = np.zeros(n + 1, bool)
    border[np.searchsorted(place, ends)] = True  # a text ends before this character
    border[0] = True
    start = border[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = np.flatnonzero((kind[:-1] == _BLANK) & (kind[1:] != _BLANK) & ~border[1:n])  # the last of white space before a word
    start[blank] = True
    start[blank[char[blank] == 32] + 1] = False
    mark = np.flatnonzero((char == 39) & start)
    mark = mark[mark + 1 < n]
    mark = mark[~border[mark + 1]]
    two = char[mark + 1]
    three = np.where(border[np.minimum(mark + 2, n)], 0, char[np.minimum(mark + 2, n - 1)])
    single = np.isin(two, [ord(c) for c in "stmd"])
    double = ((two == ord("r")) & (three == ord("e"))) | ((two == ord("v")) & (three == ord("e"))) | ((two == ord("l")) & (three == ord("l")))
    for which, length in ((single, 2), (double, 3)):
        own = mark[which]
        start[own + 1] = False
        after = own + length
        start[after[after < n]] = True
    first = np.flatnonzero(start)
    begin = place[first]
    return begin, np.append(begin[1:], len(data)) - begin


def encode(transducer: Transducer, texts: pa.Array) -> pa.Array:
    """Token ids of each text; null stays null, an empty text has none."""
    data, offsets = utf8_parts(texts)
    ids, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
    for a, b in blocks(offsets, BLOCK):
        own, ends = data[offsets[a] : offsets[b]], offsets[a + 1 : b + 1] - offsets[a]
        tokens, place = transducer.words(own, *cut(own, ends))
        ids.append(tokens)
        counts.append(np.diff(np.searchsorted(place, ends, "left"), prepend=0))
    ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    mask = texts.is_null() if texts.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(ids)), mask=mask)


#: The states of the UTF-8 machine: 0 accepts, 1 rejects; the others wait for so many bytes, the next of them from a range.
_WAITS = {2: (0x80, 0xBF, 0), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 2), 5: (0x80, 0x9F, 2), 6: (0x80, 0xBF, 3), 7: (0x90, 0xBF, 3), 8: (0x80, 0x8F, 3)}


def _machine() -> np.ndarray:
    out = np.ones((9, 256), np.uint8)
    out[0, :0x80] = 0
    for low, high, state in ((0xC2, 0xDF, 2), (0xE0, 0xE0, 4), (0xE1, 0xEC, 3), (0xED, 0xED, 5), (0xEE, 0xEF, 3), (0xF0, 0xF0, 7), (0xF1, 0xF3, 6), (0xF4, 0xF4, 8)):
        out[0, low : high + 1] = state
    for state, (low, high, then) in _WAITS.items():
        out[state, low : high + 1] = then
    return out


UTF8 = _machine()


class StreamDecoder:
    """Text of token ids that come piece by piece: feed gives what is complete, finish the rest. Bad bytes become U+FFFD."""

    def __init__(self, merges: Merges):
        self.merges, self.state, self.kept = merges, 0, bytearray()

    def feed(self, ids: list[int]) -> str:
        out: list[str] = []
        for token in ids:
            raw = self.merges.bytes.get(token)
            if raw is None:
                raise ValueError(f"no token {token}")
            for byte in raw:
                self._one(byte, out)
        return "".join(out)

    def _one(self, byte: int, out: list[str]) -> None:
        state = UTF8[self.state, byte]
        if state == 1:
            if self.kept:  # what came so far is one bad sequence; the byte may begin another
                out.append("�")
                self.kept.clear()
                self.state = 0
                self._one(byte, out)
            else:
                out.append("�")
            return
        self.kept.append(byte)
        self.state = int(state)
        if state == 0:
            out.append(self.kept.decode())
            self.kept.clear()

    def finish(self) -> str:
        out = "�" if self.kept else ""
        self.kept.clear()
        self.state = 0
        return out


class Decoder:
    """Columns of token ids as texts: the machine runs over whole tokens, and byte by byte only where one breaks a character."""

    def __init__(self, merges: Merges):
        self.merges = merges
        top = max(merges.bytes) + 1
        raw = [merges.bytes.get(t, b"") for t in range(top)]
        self.size = np.array([len(r) for r in raw], np.int64)
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.begin = np.cumsum(self.size) - self.size
        self.whole = np.array([_ends(r) == 0 for r in raw])

    def texts(self, ids: pa.Array) -> pa.Array:
        """Null stays null; a list with an unknown or null id is an error."""
        if ids.flatten().null_count:
            raise ValueError("a null among the token ids")
        lens = pa.compute.list_value_length(ids).fill_null(0).to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lens)])
        parts = [self._block(ids.slice(a, b - a)) for a, b in blocks(ends, BLOCK // 4)]  # the temporary arrays stay small
        return pa.chunked_array(parts, pa.string()).combine_chunks() if parts else pa.array([], pa.string())

    def _block(self, ids: pa.Array) -> pa.Array:
        tokens = ids.flatten().to_numpy()
        if len(tokens) and (tokens.min() < 0 or tokens.max() >= len(self.size) or not self.size[tokens].all()):
            raise ValueError("an id that is no token")
        lens = pa.compute.list_value_length(ids).fill_null(0).to_numpy()
        many = self.size[tokens]
        ahead = np.concatenate([[0], np.cumsum(many)])
        data = self.data[np.repeat(self.begin[tokens] - ahead[:-1], many) + np.arange(int(ahead[-1]))]
        ends = np.concatenate([[0], np.cumsum(lens)])
        offsets = ahead[ends]
        bad = self._bad(tokens, ends, data, ahead)
        if len(bad):
            out = [data[offsets[r] : offsets[r + 1]].tobytes().decode() if r not in bad else None for r in range(len(ids))]
            for r in bad:
                d = StreamDecoder(self.merges)
                out[r] = d.feed(tokens[ends[r] : ends[r + 1]].tolist()) + d.finish()
            made = pa.array(out, pa.string())
        else:
            made = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())).cast(pa.string())
        return pa.compute.if_else(ids.is_valid(), made, pa.scalar(None, pa.string())) if ids.null_count else made

    def _bad(self, tokens: np.ndarray, ends: np.ndarray, data: np.ndarray, ahead: np.ndarray) -> set[int]:
        """Rows that aren't UTF-8. Runs of broken tokens step through the machine together."""
        broken = np.flatnonzero(~self.whole[tokens])
        if not len(broken):
            return set()
        row = np.searchsorted(ends, broken, "right") - 1
        new = np.ones(len(broken), bool)
        new[1:] = (broken[1:] != broken[:-1] + 1) | (row[1:] != row[:-1])
        at, stop = ahead[broken[new]], ahead[broken[np.append(new[1:], True)] + 1]
        state = np.zeros(len(at), np.uint8)
        live = np.arange(len(at))
        while len(live):
            state[live] = UTF8[state[live], data[at[live]]]
            at[live] += 1
            live = live[(at[live] < stop[live]) & (state[live] != 1)]
        return set(row[new][state != 0].tolist())


def _ends(raw: bytes) -> int:
    state = 0
    for byte in raw:
        state = int(UTF8[state, byte])
        if state == 1:
            break
    return state


@lru_cache(2)
def _made(digest: str, holder: object) -> tuple[Transducer, Decoder]:
    merges = Merges.read(holder.blob)
    return Transducer(merges), Decoder(merges)


class _Holder:
    """A vocabulary's file; equal ones count as one for the cache of a worker."""

    def __init__(self, blob: bytes):
        self.blob, self.digest = blob, hashlib.md5(blob).hexdigest()

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Holder) and self.digest == other.digest

    def __hash__(self) -> int:
        return hash(self.digest)


class Codec:
    """encode and decode columns with the vocabulary of a file in rank format, read on the driver and broadcast (under 1 MB)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            self._shared = spark.sparkContext.broadcast(_Holder(f.read()))

    def encode(self, text: Column) -> Column:
        shared = self._shared

        def run(texts: pa.Array) -> pa.Array:
            return encode(_made(shared.value.digest, shared.value)[0], texts)

        return F.arrow_udf(run, T.ArrayType(T.IntegerType()))(text)

    def decode(self, ids: Column) -> Column:
        shared = self._shared

        def run(ids: pa.Array) -> pa.Array:
            return _made(shared.value.digest, shared.value)[1].texts(ids)

        return F.arrow_udf(run, T.StringType())(ids)


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row (doc_id, ids, n_tokens, round_trip) for each row; round_trip tells whether the decoded ids are the text again.

    Null text: null ids, null n_tokens, null round_trip. Empty text: no ids. Very long texts and words: whole. Repeated rows: each by
    itself. Null doc_id: stays null. Empty table: empty result. Other columns: unread.
    """
    codec = Codec(docs.sparkSession, path)
    base = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    done = base.withColumn("ids", codec.encode(F.col("text")))
    return done.select("doc_id", "ids", F.when(F.col("ids").isNotNull(), F.size("ids")).alias("n_tokens"), (codec.decode(F.col("ids")) == F.col("text")).alias("round_trip"))


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """encoded with the texts of its ids in a new last column; ids may end within a character, which becomes U+FFFD. A column of
    that name makes way for it. Null ids: null text. No ids: empty text. Unknown ids: an error."""
    (new,) = fresh(encoded, "decoded")
    out = encoded.withColumn(new, Codec(encoded.sparkSession, path).decode(quoted(ids)))
    return out.drop(quoted(text)).withColumnRenamed(new, text) if text in encoded.columns else out.withColumnRenamed(new, text)
