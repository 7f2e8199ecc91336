"""Byte-level BPE as deterministic transducers that run over numpy arrays.

Two machines are compiled from a tokenizer file:

* The *splitter* reads character classes and marks where pieces begin. Its
  transitions carry the marks, up to one character late, where the pattern looks
  ahead. Texts are cut into chunks; a chunk is a map from entry state to exit state
  and number of marks, and the maps compose, by a parallel prefix scan, to the entry
  state of every chunk.
* The *counter* reads the bytes of a piece. Its state is the set of suffixes that can
  still grow into a token, as nodes of the trie of tokens. A transition is annotated
  with the one token that ends there, and with the number of tokens up to there: one
  more than at the token's beginning. All pieces of a slice move in step.

The counter is deterministic: for every prefix of a piece there is exactly one last
token of its encoding, and two tokens may stand side by side exactly if no merge
joins the edges of the two while both are there. So the last token of a prefix is the
suffix token that may follow the last token of the prefix before it.

Results are kept per distinct piece in a table; when it is full it is emptied, which
costs time only. Only a slice that has more distinct pieces than the table, such as one
very long text of numbers, makes it larger, until a later slice brings new pieces.
"""

from __future__ import annotations

import json

import numpy as np

from odflow.llm.text import run_hashes

LONG_PIECE = 512
CHUNK = 128
MAX_PIECES = 1 << 19
MAX_PAIRS = 1 << 20

_NONE = -1


class HashTable:
    """64-bit keys (not 0) to int32 values, open addressing, whole arrays at a time."""

    def __init__(self, bits: int) -> None:
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)
        self.size = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(
                np.int64
            ) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values; -1 for a key that is not there."""
        out = np.full(len(keys), _NONE, np.int32)
        slots, rest = self._slots(keys), np.arange(len(keys))
        while len(rest):
            found = self.keys[slots]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[slots[hit]]
            on = ~hit & (found != 0)
            slots, rest = (slots[on] + 1) & self.mask, rest[on]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not there; at most half of the slots."""
        self.size += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = keys[free]
            own = free & (self.keys[slots] == keys)
            self.values[slots[own]] = values[own]
            keys, values = keys[~own], values[~own]
            slots = (slots[~own] + 1) & self.mask

    def clear(self) -> None:
        self.keys[:] = 0
        self.size = 0


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + i): b for i, b in enumerate(other)})
    return letters


class Counter:
    """The transducer over the bytes of a piece."""

    def __init__(self, vocab: dict[str, int], merges: list, special: set[str]) -> None:
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.bytes_of = {i: as_bytes(s) for s, i in vocab.items() if s not in special}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        self.rank = {
            (as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)
        }
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.length = np.ones(max(vocab.values()) + 1, np.int32)
        for i, b in self.bytes_of.items():
            self.length[i] = len(b)
        self._build_trie()
        self._build_edges()
        self.pairs = HashTable(MAX_PAIRS.bit_length())
        self.reset()

    def reset(self, room: int = 0) -> None:
        """Forget the encodings of pieces."""
        room = max(room, MAX_PIECES)
        self.pieces = HashTable(room.bit_length())
        self.pool = np.zeros(1 << 20, np.uint32)
        self.pool_size = 0
        self.at = np.zeros(room + 1, np.int64)
        self.n_tokens = np.zeros(room, np.int32)

    def encode_plain(self, piece: bytes) -> list[bytes]:
        """Merge the best pair until none is left; for short strings."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(
                range(len(parts) - 1),
                key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60),
            )
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _build_trie(self) -> None:
        children: list[dict[int, int]] = [{}]
        token = [-1]
        for i, b in self.bytes_of.items():
            if len(self.encode_plain(b)) > 1:
                continue  # never comes out of the merges
            node = 0
            for c in b:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = len(children)
                    children[node][c] = nxt
                    children.append({})
                    token.append(-1)
                node = nxt
            token[node] = i
        self.children, self.token = children, token
        edges = [
            (node << 8 | c, child)
            for node, branch in enumerate(children)
            for c, child in branch.items()
        ]
        # Node 0 with byte 0 would be key 0: keys are one higher.
        self.edges = HashTable(len(edges).bit_length() + 1)
        self.edges.put(
            np.array([k + 1 for k, _ in edges], np.uint64),
            np.array([v for _, v in edges], np.int32),
        )
        self.token_at = np.array(token, np.int32)
        self.grows = np.array([bool(c) for c in children])

    def _build_edges(self) -> None:
        """What stands at the right and left edge of a token while it is built.

        Every edge symbol comes with the rank of the merge that uses it up, none
        for the token itself.
        """
        made_by = {a + b: (a, b, r) for (a, b), r in self.rank.items()}
        never = len(self.rank)
        self.right_edge, self.left_edge = {}, {}
        for side, edges in ((1, self.right_edge), (0, self.left_edge)):
            for i, b in self.bytes_of.items():
                edge = [(i, never)]
                while b in made_by:
                    merge = made_by[b]
                    b = merge[side]
                    edge.append((self.id_of[b], merge[2]))
                edges[i] = edge
        self.pair_rank = {
            self.id_of[a] << 20 | self.id_of[b]: r for (a, b), r in self.rank.items()
        }

    def _may_follow(self, a: int, b: int) -> bool:
        """No merge joins the edges of ``a`` and ``b`` while both are there.

        Of equal merges the left one comes first.
        """
        rank, left_edge = self.pair_rank.get, self.left_edge[b]
        for x, until_x in self.right_edge[a]:
            x <<= 20
            for y, until_y in left_edge:
                r = rank(x | y)
                if r is not None and r < until_x and r <= until_y:
                    return False
        return True

    def _mask_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`_may_follow` for arrays; ``a`` is -1 at the beginning of a piece."""
        keys = (a.astype(np.int64) + 2).astype(np.uint64) << np.uint64(32)
        keys |= b.astype(np.uint64)
        out = self.pairs.get(keys)
        if (out < 0).any():
            new = np.unique(keys[out < 0])
            if self.pairs.size + len(new) > MAX_PAIRS:
                self.pairs.clear()
                new = np.unique(keys)
                if len(new) > MAX_PAIRS:
                    half = len(keys) // 2
                    halves = (slice(half), slice(half, None))
                    return np.concatenate([self._mask_follow(a[x], b[x]) for x in halves])
            firm = [
                k >> 32 == 1 or self._may_follow((k >> 32) - 2, k & 0xFFFFFFFF)
                for k in new.tolist()
            ]
            self.pairs.put(new, np.array(firm, np.int32))
            out = self.pairs.get(keys)
        return out > 0

    def _encode(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one behind the other, and their numbers."""
        lengths = (ends - starts).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(lengths + 1)])
        # By piece and position: the last token before it, and where it begins.
        last = np.full(base[-1], _NONE, np.int32)
        begin = np.zeros(base[-1], np.int64)
        order = np.argsort(-lengths, kind="stable")
        sizes = lengths[order]
        long = int(np.searchsorted(-sizes, -LONG_PIECE, "left"))
        for i in order[:long].tolist():
            self._walk_one(data[starts[i] : ends[i]].tobytes(), int(base[i]), last, begin)
        order, sizes = order[long:], sizes[long:]
        longest = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(longest), "left")
        # Growing suffixes: rank of the piece by length, begin, node.
        rank = np.zeros(0, np.int64)
        origin, node = rank, rank
        for j, k in enumerate(alive.tolist()):
            stay = rank < k
            rank = np.concatenate([rank[stay], np.arange(k)])
            origin = np.concatenate([origin[stay], base[order[:k]] + j])
            node = np.concatenate([node[stay], np.zeros(k, np.int64)])
            byte = data[starts[order[:k]] + j]
            child = self.edges.get(((node << 8 | byte[rank]) + 1).astype(np.uint64))
            there = child >= 0
            rank, origin, node = rank[there], origin[there], child[there].astype(np.int64)
            token = self.token_at[node]
            ends_here = np.flatnonzero(token >= 0)
            token = token[ends_here]
            firm = self._mask_follow(last[origin[ends_here]], token)
            ends_here, token = ends_here[firm], token[firm]
            here = base[order[rank[ends_here]]] + j + 1
            last[here] = token
            begin[here] = origin[ends_here]
            grows = self.grows[node]
            rank, origin, node = rank[grows], origin[grows], node[grows]
        chosen = np.zeros(base[-1], bool)
        at, low = base[1:] - 1, base[:-1]
        while len(at):
            on = at > low
            at, low = at[on], low[on]
            chosen[at] = True
            at = begin[at]
        place = np.flatnonzero(chosen)
        return last[place].astype(np.uint32), np.diff(np.searchsorted(place, base))

    def _walk_one(self, piece: bytes, base: int, last, begin) -> None:
        """One long piece, byte by byte; fills ``last`` and ``begin``."""
        growing, lasts = [], [_NONE]
        for j, byte in enumerate(piece):
            growing.append((j, 0))
            kept, token = [], None
            for origin, node in growing:
                child = self.children[node].get(byte)
                if child is None:
                    continue
                end = self.token[child]
                if token is None and end >= 0:
                    if lasts[origin] == _NONE or self._may_follow(lasts[origin], end):
                        token = end
                        last[base + j + 1], begin[base + j + 1] = end, base + origin
                if self.children[child]:
                    kept.append((origin, child))
            growing = kept
            lasts.append(token)

    def encode(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> np.ndarray:
        """The entry of every piece in ``at`` and ``n_tokens``."""
        keys = run_hashes(data, starts, ends) | np.uint64(1)
        entry = self.pieces.get(keys)
        if (entry < 0).any():
            new, first = np.unique(keys[entry < 0], return_index=True)
            which = np.flatnonzero(entry < 0)[first]
            if self.pieces.size + len(new) > MAX_PIECES:
                self.reset()
                new, which = np.unique(keys, return_index=True)
                if len(new) > MAX_PIECES:
                    self.reset(len(new))
            for low in range(0, len(new), MAX_PIECES):
                part = which[low : low + MAX_PIECES]
                self._keep(new[low : low + MAX_PIECES], *self._encode(data, starts[part], ends[part]))
            entry = self.pieces.get(keys)
        return entry

    def _keep(self, new: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Add pieces with their ids, one behind the other, and the numbers of these."""
        size = self.pieces.size
        while self.pool_size + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.pool_size : self.pool_size + len(ids)] = ids
        self.at[size : size + len(new)] = self.pool_size + np.cumsum(n) - n
        self.n_tokens[size : size + len(new)] = n
        self.pool_size += len(ids)
        self.pieces.put(new, np.arange(size, size + len(new), dtype=np.int32))


# Classes of characters. Letters of contractions have classes of their own.
BLANK, WHITE, LETTER, NUMBER, OTHER, QUOTE, STMD, RV, ELL, EE, BREAK = range(11)
_LETTERS = (LETTER, STMD, RV, ELL, EE)
_WHITES = (BLANK, WHITE)

# States: what the current piece is so far. "1" is one white character, "M" more.
(_FRESH, _L, _N, _P, _Q, _QRV, _QL, _1B, _1W, _MB, _MW) = range(11)
N_STATES = 11
_HERE, _BACK = 1, 2  # marks: a piece begins here, or one character back


def _begin(c: int) -> int:
    if c in _WHITES:
        return _1B if c == BLANK else _1W
    if c in _LETTERS:
        return _L
    return {NUMBER: _N, OTHER: _P, QUOTE: _Q, BREAK: _FRESH}[c]


def _attach(c: int) -> int:
    """The run that a single blank before ``c`` belongs to."""
    return _L if c in _LETTERS else _N if c == NUMBER else _P


def _move(state: int, c: int) -> tuple[int, int]:
    """Next state and marks."""
    begin = _begin(c), _HERE
    if c == BREAK:
        late = _BACK if state in (_QRV, _QL) else 0
        return _FRESH, _HERE | late
    if state == _L:
        return (_L, 0) if c in _LETTERS else begin
    if state == _N:
        return (_N, 0) if c == NUMBER else begin
    if state == _P:
        return (_P, 0) if c in (OTHER, QUOTE) else begin
    if state == _Q:
        known = {STMD: _FRESH, RV: _QRV, ELL: _QL, OTHER: _P, QUOTE: _P}
        return (known[c], 0) if c in known else begin
    if state in (_QRV, _QL):
        if c == (EE if state == _QRV else ELL):
            return _FRESH, 0
        after, mark = _move(_L, c)
        return after, mark | _BACK
    if state in (_1B, _1W, _MB, _MW):
        if c in _WHITES:
            return (_MB if c == BLANK else _MW), 0
        late = _BACK if state in (_MB, _MW) else 0
        if state in (_1B, _MB):
            return _attach(c), late
        return begin[0], begin[1] | late
    return begin


class Splitter:
    """Marks the beginnings of pieces."""

    def __init__(self, pieces_of) -> None:
        """``pieces_of(text)`` gives the number of pieces the library makes."""
        self._pieces_of = pieces_of
        self.classes = np.full(0x110000, 255, np.uint8)
        for c, kind in zip(" '\0", (BLANK, QUOTE, OTHER), strict=True):
            self.classes[ord(c)] = kind
        for letters, kind in (("stmd", STMD), ("rv", RV), ("l", ELL), ("e", EE)):
            self.classes[[ord(c) for c in letters]] = kind
        moves = [[_move(s, c) for c in range(11)] for s in range(N_STATES)]
        self.next = np.array([[m[0] for m in row] for row in moves], np.uint8)
        self.mark = np.array([[m[1] for m in row] for row in moves], np.uint8)
        self.settled = self._settling_length()

    def _settling_length(self) -> int:
        """Characters after which the state no longer depends on the entry state."""
        images, steps = {frozenset(range(N_STATES))}, 0
        while any(len(x) > 1 for x in images):
            images = {
                frozenset(int(self.next[s, c]) for s in x)
                for x in images
                for c in range(11)
            }
            steps += 1
            if steps > CHUNK:
                raise ValueError("the pattern keeps its state for too long")
        return steps

    def class_of(self, chars: np.ndarray) -> np.ndarray:
        kinds = self.classes[chars]
        if kinds.size and kinds.max() == 255:
            for c in np.unique(chars[kinds == 255]).tolist():
                self.classes[c] = self._ask(chr(c))
            kinds = self.classes[chars]
        return kinds

    def _ask(self, c: str) -> int:
        """A character's class, by what the library joins it with."""
        if self._pieces_of("a" + c) == 1:
            return LETTER
        if self._pieces_of("1" + c) == 1:
            return NUMBER
        return OTHER if self._pieces_of("!" + c) == 1 else WHITE

    def begins(self, kinds: np.ndarray) -> np.ndarray:
        """True where a piece begins. A text ends with BREAK, a piece of its own."""
        n = len(kinds)
        chunks = -(-n // CHUNK)
        grid = np.full((chunks, CHUNK), BREAK, np.uint8)
        grid.reshape(-1)[:n] = kinds
        grid = np.ascontiguousarray(grid.T)
        marks = np.zeros((CHUNK, chunks), np.uint8)
        # All entry states, until the state is the same for every one of them.
        head = np.empty((self.settled, N_STATES, chunks), np.uint8)
        state = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], chunks, 1)
        for j in range(self.settled):
            head[j] = self.mark[state, grid[j]]
            state = self.next[state, grid[j]]
        settled = state[0]
        for j in range(self.settled, CHUNK):
            marks[j] = self.mark[settled, grid[j]]
            settled = self.next[settled, grid[j]]
        leave = np.repeat(settled[:, None], N_STATES, 1)
        entry = entry_states(leave)
        marks[: self.settled] = head[:, entry, np.arange(chunks)]
        flat = np.ascontiguousarray(marks.T).reshape(-1)[:n]
        found = (flat & _HERE) > 0
        found[:-1] |= (flat[1:] & _BACK) > 0
        return found


def entry_states(leave: np.ndarray) -> np.ndarray:
    """Entry state of every chunk: a parallel prefix scan over the chunks' maps.

    ``leave[k, s]`` is the state behind chunk k entered in state s. Maps compose
    pairwise at doubling distance; the first chunk is entered fresh.
    """
    maps, distance = leave.copy(), 1
    while distance < len(maps):
        later = maps[distance:]
        maps[distance:] = np.take_along_axis(later, maps[:-distance], 1)
        distance *= 2
    entry = np.full(len(maps), _FRESH, np.uint8)
    entry[1:] = maps[:-1, _FRESH]
    return entry


class Tokenizer:
    """Token counts and ids of many texts, as the library gives them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer as Library

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (
            model["type"] != "BPE"
            or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space")
            or spec["normalizer"]
            or model.get("ignore_merges")
        ):
            raise ValueError(f"{path} is not plain byte-level BPE")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = Library.from_file(path).pre_tokenizer.pre_tokenize_str
        self.counter = Counter(model["vocab"], model["merges"], set(self.special))
        self.splitter = Splitter(lambda text: len(split(text)))
        if any(len(s) < 2 for s in self.special):
            raise ValueError("special strings of one character are not supported")

    def _pieces(self, data: np.ndarray, offsets: np.ndarray):
        """Pieces by byte position in ``joined``, their texts, and special ids.

        Texts are joined with a zero byte behind each. A special string is cut out
        first, as the library does, and leaves its id at the break in its place.
        """
        breaks, ids, texts = offsets[1:].tolist(), [-1] * (len(offsets) - 1), None
        raw = data.tobytes()
        if any(s.encode() in raw for s in self.special):
            parts, ids, owner = [], [], []
            for i in range(len(offsets) - 1):
                for part, special in self._cut(raw[offsets[i] : offsets[i + 1]]):
                    parts.append(part)
                    ids.append(special)
                    owner.append(i)
            raw = b"".join(parts)
            breaks = np.cumsum([len(p) for p in parts]).tolist()
            texts = np.array(owner, np.int64)
        source = np.frombuffer(raw, np.uint8)
        breaks = np.array(breaks, np.int64)
        if texts is None:
            texts = np.arange(len(breaks))
        joined = np.insert(source, breaks, 0)
        stops = breaks + np.arange(len(breaks))
        chars = np.frombuffer(joined.tobytes().decode().encode("utf-32-le"), np.uint32)
        kinds = self.splitter.class_of(chars)
        place = np.flatnonzero((joined & 0xC0) != 0x80)
        kinds[np.searchsorted(place, stops)] = BREAK
        starts = place[self.splitter.begins(kinds)]
        ends = np.append(starts[1:], len(joined))
        is_stop = np.zeros(len(joined), bool)
        is_stop[stops] = True
        real = ~is_stop[starts]
        return joined, starts[real], ends[real], stops, texts, np.array(ids, np.int64)

    def _cut(self, text: bytes) -> list[tuple[bytes, int]]:
        """``text`` cut at special strings: ``(part, id behind it or -1)``."""
        parts: list[tuple[bytes, int]] = []
        start = 0
        places = {s: text.find(s.encode()) for s in self.special}
        while True:
            for s, at in places.items():
                if 0 <= at < start:
                    places[s] = text.find(s.encode(), start)
            found = [(at, -len(s), s) for s, at in places.items() if at >= 0]
            if not found:
                return [*parts, (text[start:], -1)]
            at, _, special = min(found)
            parts.append((text[start:at], self.special[special]))
            start = at + len(special.encode())

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of every text."""
        joined, starts, ends, stops, texts, ids = self._pieces(data, offsets)
        entry = self.counter.encode(joined, starts, ends)
        tokens = self.counter.n_tokens[entry]
        part = np.searchsorted(stops, starts)
        total = np.bincount(texts[part], tokens, len(offsets) - 1)
        total += np.bincount(texts, ids >= 0, len(offsets) - 1)
        return total.astype(np.int64)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and their offsets by text."""
        joined, starts, ends, stops, texts, special = self._pieces(data, offsets)
        entry = self.counter.encode(joined, starts, ends)
        # Pieces and the breaks that stand for special strings, in text order.
        marked = np.flatnonzero(special >= 0)
        place = np.concatenate([starts, stops[marked]])
        order = np.argsort(place, kind="stable")
        n = np.concatenate(
            [self.counter.n_tokens[entry], np.ones(len(marked), np.int32)]
        )[order].astype(np.int64)
        at = np.concatenate([self.counter.at[entry], -1 - special[marked]])[order]
        ends_at = np.cumsum(n)
        inside = np.arange(ends_at[-1] if len(n) else 0) - np.repeat(ends_at - n, n)
        source = np.repeat(at, n) + inside
        ids = self.counter.pool[np.maximum(source, 0)]
        ids[source < 0] = -1 - source[source < 0]
        text = texts[np.searchsorted(stops, place[order])]
        total = np.bincount(text, n, len(offsets) - 1).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(total)])


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The compiled machines of a file, once per worker."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]
