"""Byte-level BPE encoding and decoding with a finite-state transducer (operator 7).

The merges are compiled into a transducer that reads bytes and writes token ids. Its nondeterministic
form is small: a state is the last finished token and a place in the trie of all tokens, and a token
may end wherever it stands well behind the one before it, that is where the merges of both together
give back just these two. Any such chain is the BPE encoding of its bytes, and every prefix has
exactly one, so the transducer is unambiguous. It is made deterministic while texts are read: a
deterministic state holds the open alternatives with what each still has to write, and a token is
written as soon as all alternatives agree on it. No alternative is open for longer than the longest
token, so the lookahead is bounded, and a piece of any length takes linear time.

Most pieces are short, and of those that no earlier text had there are too many for the states one can keep.
The new ones of a batch go through the nondeterministic form together, as arrays, a token of each at a time.

Null and empty texts have no ids. Repeated rows and ties need no care: each row stands for itself.
Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import MEMO, release_memory, small_batches, texts_of

#: Deterministic states a transducer keeps; where they end, it runs in its nondeterministic form.
STATES = 60_000
#: Words, and pieces of words, whose ids a worker remembers, for two generations.
REMEMBER = 250_000
#: Bytes of a piece that is encoded alone, by the deterministic form; shorter ones go together, so many at a time.
LONG, TOGETHER = 48, 1 << 15


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Transducer:
    """Bytes of one piece in, token ids out; states are made when first reached."""

    def __init__(self, ranks: dict[bytes, int], limit: int | None = None, pairs: int = 3 * MEMO) -> None:
        self.ranks = ranks
        self.limit = STATES if limit is None else limit
        self.most_pairs = pairs
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.parts: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]  # of each place in the trie; -1 where no token ends
        for rank in sorted(self.bytes):
            self._compile(rank)
        self.start = State(-1, b"", [(-1, 0, ())])
        self.states = {(-1, b""): self.start}

    def _compile(self, rank: int) -> None:
        """Add a token to the trie, unless the merges of its own bytes don't lead to it."""
        token = self.bytes[rank]
        if len(token) > 1:
            halves = self._merge(token, rank)
            if len(halves) != 2:
                return
            self.parts[rank] = (self.ranks[halves[0]], self.ranks[halves[1]])
        node = 0
        for byte in token:
            following = self.trie[node].get(byte)
            if following is None:
                following = len(self.trie)
                self.trie.append({})
                self.token_at.append(-1)
                self.trie[node][byte] = following
            node = following
        self.token_at[node] = rank

    def _merge(self, token: bytes, below: int) -> list[bytes]:
        """The parts of ``token`` after all merges of a lower rank than ``below``."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b, below) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(ranked)
            if least >= below:
                break
            at = ranked.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, a: int, b: int) -> bool:
        """Whether the merges of both tokens' bytes together leave ``a`` and ``b``.

        Merges are undone from the newest on, at the seam only: ``a`` falls back to its right half,
        ``b`` to its left half. A merge across the seam spoils the pair if it ranks before the merges
        that used up the two parts; of equal ranks, the one further left goes first.
        """
        key = a << 32 | b
        a_used = b_used = len(self.bytes) + (1 << 30)
        good = True
        while True:
            across = self.ranks.get(self.bytes[a] + self.bytes[b])
            if across is not None and across < a_used and across <= b_used:
                good = False
                break
            in_a, in_b = self.parts.get(a), self.parts.get(b)
            if in_a is None and in_b is None:
                break
            if in_b is None or (in_a is not None and a > b):
                a_used, a = a, in_a[1]
            else:
                b_used, b = b, in_b[0]
        if len(self.pairs) >= self.most_pairs:
            self.pairs.clear()
        self.pairs[key] = good
        return good

    def _move(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        """The state behind ``byte``, and the tokens on which the alternatives now agree."""
        trie, token_at, before = self.trie, self.token_at, state.before
        known, ended = self.pairs.get, False
        reached = []
        for last, node, owed in state.alternatives:
            node = trie[node].get(byte)
            if node is None:
                continue
            if trie[node]:
                reached.append((last, node, owed))
            if ended:  # no prefix has a second encoding
                continue
            token = token_at[node]
            if token >= 0:
                ended = last < 0 or known(last << 32 | token)
                if ended is None:
                    ended = self.follows(last, token)
                if ended:
                    reached.append((token, 0, (*owed, token)))
        unwritten = state.unwritten + bytes((byte,))
        first, shared = reached[0][2], 0
        if first:
            if len(reached) == 1:
                shared = len(first)
            else:
                shortest = min([len(owed) for _, _, owed in reached])
                while shared < shortest and all([owed[shared] == first[shared] for _, _, owed in reached]):
                    shared += 1
            if shared:
                before = first[shared - 1]
                unwritten = unwritten[sum([len(self.bytes[t]) for t in first[:shared]]) :]
        written = first[:shared]
        key = (before, unwritten)
        target = self.states.get(key)
        if target is None:
            if shared:
                reached = [(last, node, owed[shared:]) for last, node, owed in reached]
            target = self.states[key] = State(before, unwritten, reached)
        move = state.moves[byte] = (target, written)
        return move

    def _search(self, last: int, rest: bytes) -> list[int]:
        """What the nondeterministic transducer writes for ``rest`` behind token ``last``.

        Depth first, longest token first; a dead end costs one step back, and no place is tried
        twice with the same token before it.
        """
        trie, token_at, known = self.trie, self.token_at, self.pairs.get
        path: list[tuple[int, list[tuple[int, int]], int]] = []
        before = last
        dead: set[tuple[int, int]] = set()
        at, end = 0, len(rest)
        while at < end:
            ends, node, stop = [], 0, at
            for byte in rest[at : at + self.longest]:
                node = trie[node].get(byte)
                if node is None:
                    break
                stop += 1
                token = token_at[node]
                if token >= 0:
                    ends.append((token, stop))
            while True:
                while ends:
                    token, stop = ends.pop()
                    fits = last < 0 or known(last << 32 | token)
                    if fits is None:
                        fits = self.follows(last, token)
                    if fits and (token, stop) not in dead:
                        break
                else:
                    dead.add((last, at))
                    at, ends, _ = path.pop()
                    last = path[-1][2] if path else before
                    continue
                break
            path.append((at, ends, token))
            last, at = token, stop
        return [token for _, _, token in path]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece; a piece that is itself a token stays whole."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, ids = self.start, []
        for at, byte in enumerate(piece):
            move = state.moves.get(byte)
            if move is None:
                if len(self.states) >= self.limit:
                    ids.extend(self._search(state.before, state.unwritten + piece[at:]))
                    return ids
                move = self._move(state, byte)
            state = move[0]
            if move[1]:
                ids.extend(move[1])
        for _, node, owed in state.alternatives:
            if node == 0:
                ids.extend(owed)
                break
        return ids


class State:
    """The last token written, the bytes read since, and the alternatives these leave open."""

    __slots__ = ("before", "unwritten", "alternatives", "moves")

    def __init__(self, before: int, unwritten: bytes, alternatives: list) -> None:
        self.before = before
        self.unwritten = unwritten
        self.alternatives = alternatives
        self.moves: dict[int, tuple[State, tuple[int, ...]]] = {}


class Table:
    """Whole numbers from 0 on by 64-bit keys, looked up for many keys at once; -1 for keys that aren't there."""

    def __init__(self, pairs: dict[int, int]) -> None:
        bits = max(4 * len(pairs), 16).bit_length()
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        keys, values = (np.fromiter(x, np.int64, len(pairs)) for x in (pairs.keys(), pairs.values()))
        place = self._places(keys)
        while len(keys):  # who finds its place taken goes to the next one
            free = np.flatnonzero(self.keys[place] < 0)
            taken = free[np.unique(place[free], return_index=True)[1]]
            self.keys[place[taken]], self.values[place[taken]] = keys[taken], values[taken]
            rest = np.ones(len(keys), bool)
            rest[taken] = False
            keys, values, place = keys[rest], values[rest], (place[rest] + 1) & (len(self.keys) - 1)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        place = self._places(keys)
        there = self.keys[place]
        out = self.values[place]
        odd = np.flatnonzero((there != keys) & (there >= 0))
        while len(odd):
            next_place = (place[odd] + 1) & (len(self.keys) - 1)
            place[odd] = next_place
            there, out[odd] = self.keys[next_place], self.values[next_place]
            odd = odd[(there != keys[odd]) & (there >= 0)]
        out[self.keys[place] != keys] = -1
        return out


class Together:
    """The nondeterministic transducer run over many pieces at once, a step of all pieces after the other.

    Each piece goes depth first, longest token first, like ``Transducer.encode`` where its states end; the
    places in the trie and the pairs of tokens are looked up in arrays.
    """

    def __init__(self, transducer: Transducer) -> None:
        self.transducer = transducer
        ranks = transducer.ranks
        self.moves = Table({n << 8 | byte: to for n, following in enumerate(transducer.trie) for byte, to in following.items()})
        self.token_at = np.array(transducer.token_at, np.int32)
        across = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    across[a << 32 | b] = rank
        self.across = Table(across)
        n = max(transducer.bytes, default=0) + 1
        self.length = np.zeros(n, np.int32)
        self.halves = np.full((2, n), -1, np.int64)
        for rank, token in transducer.bytes.items():
            self.length[rank] = len(token)
        for rank, halves in transducer.parts.items():
            self.halves[:, rank] = halves

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``Transducer.follows`` for many pairs; a negative ``a`` stands for the beginning."""
        good = np.ones(len(a), bool)
        at = np.flatnonzero(a >= 0)
        a, b = a[at].astype(np.int64), b[at].astype(np.int64)
        a_used = np.full(len(at), np.iinfo(np.int64).max)
        b_used = a_used.copy()
        while len(at):
            across = self.across.get(a << 32 | b)
            bad = (across >= 0) & (across < a_used) & (across <= b_used)
            good[at[bad]] = False
            in_a, in_b = self.halves[1][a], self.halves[0][b]
            on = ~bad & ((in_a >= 0) | (in_b >= 0))
            at, a, b, a_used, b_used, in_a, in_b = (x[on] for x in (at, a, b, a_used, b_used, in_a, in_b))
            left = (in_b < 0) | ((in_a >= 0) & (a > b))
            a_used, b_used = np.where(left, a, a_used), np.where(left, b_used, b)
            a, b = np.where(left, in_a, a), np.where(left, b, in_b)
        return good

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of every piece; long ones, and those with many dead ends, go one by one."""
        whole, one = self.transducer.ranks.get, self.transducer.encode
        out = [b""] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            rank = whole(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) <= LONG:
                short.append(i)
            else:
                out[i] = array("I", one(piece)).tobytes()
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            for i, packed in zip(some, self._encode([pieces[i] for i in some]), strict=True):
                out[i] = array("I", one(pieces[i])).tobytes() if packed is None else packed
        return out

    def _encode(self, pieces: list[bytes]) -> list[bytes | None]:
        """The same for short pieces; None for what isn't at its end after some rounds."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        end = np.cumsum(size)
        at = end - size
        width = int(size.max(initial=0))
        path = np.zeros((width + 1, len(pieces)), np.int32)
        depth = np.zeros(len(pieces), np.int64)
        most = size.copy()  # bytes the next token may have
        open_ = np.flatnonzero(size)
        for _ in range(4 * width):
            if not len(open_):
                break
            token = self._longest(data, at[open_], most[open_], np.where(depth[open_] > 0, path[depth[open_] - 1, open_], -1))
            found = token >= 0
            on, token = open_[found], token[found]
            path[depth[on], on] = token
            depth[on] += 1
            at[on] += self.length[token]
            most[on] = end[on] - at[on]
            back = open_[~found]
            depth[back] -= 1
            undone = self.length[path[depth[back], back]]
            at[back] -= undone
            most[back] = undone - 1
            open_ = open_[at[open_] < end[open_]]
        depth[open_] = 0
        packed = path.T[np.arange(width + 1) < depth[:, None]].astype("<u4").tobytes()
        cut = [0, *np.cumsum(4 * depth).tolist()]
        return [packed[a:b] if a < b or not n else None for a, b, n in zip(cut, cut[1:], size.tolist(), strict=False)]

    def _longest(self, data: np.ndarray, at: np.ndarray, most: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The longest token of at most so many bytes at each place that may follow the last one; else -1."""
        ends: list[tuple[np.ndarray, np.ndarray]] = []  # by length, who stands at the end of a token, and which
        who = np.flatnonzero(most > 0)
        node = np.zeros(len(who), np.int64)
        for n in range(self.transducer.longest):
            if n:
                on = most[who] > n
                who, node = who[on], node[on]
            if not len(who):
                break
            node = self.moves.get(node << 8 | data[at[who] + n]).astype(np.int64)
            on = node >= 0
            who, node = who[on], node[on]
            token = self.token_at[node]
            full = token >= 0
            ends.append((who[full], token[full]))
        # Candidates of each place from the longest to the shortest, all places at once.
        shorter = np.full((len(ends) + 1, len(at)), -1, np.int32)
        count = np.zeros(len(at), np.int64)
        for places, token in ends:
            shorter[count[places], places] = token
            count[places] += 1
        out = np.full(len(at), -1, np.int32)
        left = np.flatnonzero(count)
        while len(left):
            count[left] -= 1
            token = shorter[count[left], left]
            good = self.follows(last[left], token)
            out[left[good]] = token[good]
            left = left[~good]
            left = left[count[left] > 0]
        return out


class Memory:
    """Texts to packed ids: those asked for last, and those of the time before, about ``limit`` each."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def missing(self, wanted: set[str]) -> list[str]:
        """What of ``wanted`` the caller has to put in ``known`` now; the rest is there, until the next call."""
        if len(self.known) >= self.limit:
            self.known, self.older = {}, self.known
        new = list(wanted.difference(self.known))
        values = list(map(self.older.get, new))
        self.known.update(zip(new, values, strict=True))
        return [key for key, value in zip(new, values, strict=True) if value is None]


class Words:
    """Texts to packed ids, by what stands between two spaces, with the space before it, or else by pieces.

    The pattern always splits before a space that no white space follows, so such stretches can be split
    by it one by one. What is new in a batch of texts is encoded together.
    """

    def __init__(self, transducer: Transducer, limit: int, pattern: str) -> None:
        import regex

        self.together = Together(transducer)
        self.words, self.pieces = Memory(limit), Memory(limit)
        self.split = regex.compile(pattern).findall
        self.odd = re.compile(r" (?:\s|$)").search

    def _parts(self, words: list[str]) -> list[list[str]]:
        """Pieces of each word with the space before it."""
        out: list[list[str]] = []
        for part in self.split(" " + " ".join(words)) if words else []:
            if part[0] == " ":
                out.append([part])
            else:
                out[-1].append(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts."""
        heads, rest, wanted = [], [], set()
        for text in texts:
            head, *words = [text] if self.odd(text) else text.split(" ")
            heads.append(self.split(head))
            rest.append(words)
            wanted.update(words)
        new = self.words.missing(wanted)
        parts = self._parts(new)
        single = {p[0] for p in parts if len(p) == 1}  # remembered as a word, so it need not be as a piece too
        wanted = {x for p in parts if len(p) > 1 for x in p}.union(*heads)
        pieces = self.pieces.missing(wanted)
        alone = list(single)
        ids = self.together.encode([p.encode("utf-8") for p in [*pieces, *alone]])
        self.pieces.known.update(zip(pieces, ids, strict=False))
        of_piece, of_word = self.pieces.known.__getitem__, self.words.known
        ids_alone = dict(zip(alone, ids[len(pieces) :], strict=True))
        for word, p in zip(new, parts, strict=True):
            of_word[word] = ids_alone[p[0]] if len(p) == 1 else b"".join(map(of_piece, p))
        find = of_word.__getitem__
        return [b"".join([*map(of_piece, h), *map(find, w)]) for h, w in zip(heads, rest, strict=True)]


class Vocabulary:
    """Ranks to broadcast; each worker compiles them once and keeps its transducer between tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, states: int = STATES, remember: int = REMEMBER) -> None:
        self.ranks = ranks
        self.pattern = pattern
        self.states = states
        self.remember = remember
        self._words: Words | None = None
        self._bytes: dict[int, bytes] | None = None

    @property
    def words(self) -> Words:
        if self._words is None:
            transducer = Transducer(self.ranks, self.states, 3 * self.remember)
            self._words = Words(transducer, self.remember, self.pattern)
        return self._words

    @property
    def bytes(self) -> dict[int, bytes]:
        if self._bytes is None:
            self._bytes = {rank: token for token, rank in self.ranks.items()}
        return self._bytes


class Utf8Stream:
    """An incremental UTF-8 state machine: bytes in any portions, whole characters out.

    The state is the unfinished character at the end of what came so far. Only the last three
    bytes of a portion can belong to one, so only they are stepped through.
    """

    def __init__(self) -> None:
        self.open = b""

    def feed(self, portion: bytes, last: bool = False) -> str:
        data = self.open + portion
        keep = 0 if last else self._unfinished(data)
        self.open = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                length = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < length else 0
        return 0


def _decoded(packed: bytes | None, token, portion: int) -> str:
    """What packed ids stand for, decoded ``portion`` ids at a time."""
    ids = np.frombuffer(packed or b"", "<u4").tolist()
    stream, text = Utf8Stream(), []
    for at in range(0, len(ids), portion):
        text.append(stream.feed(b"".join(map(token, ids[at : at + portion]))))
    text.append(stream.feed(b"", last=True))
    return "".join(text)


def encode(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
    states: int = STATES, remember: int = REMEMBER,
) -> DataFrame:
    """(id, ids) of every row: ids as packed little-endian unsigned 32-bit integers.

    ``states`` and ``remember`` (words, and pieces) bound what a worker holds; they change time, not ids.
    """
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(ranks, pattern, states, remember))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            ids = shared.value.words.encode(texts_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary())], [id_col, "ids"]
            )

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode(
    df: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids", portion: int = 4096
) -> DataFrame:
    """(id, ids, decoded) of every row of packed ids."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(ranks, ""))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            token = shared.value.bytes.__getitem__
            texts = [_decoded(packed, token, portion) for packed in batch.column(1).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "ids", "decoded"])

    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded string")


def round_trip(
    df: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    portion: int = 4096,
    states: int = STATES,
    remember: int = REMEMBER,
) -> DataFrame:
    """``decode`` of ``encode``, both in one task, so that one Python worker holds the tables."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(ranks, pattern, states, remember))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in small_batches(batches):
            token = shared.value.bytes.__getitem__
            ids = shared.value.words.encode(texts_of(batch.column(1)))
            texts = [_decoded(packed, token, portion) for packed in ids]
            columns = [batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "ids", "decoded"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded string")
