"""Sampled SentencePiece segmentations without replacement: Gumbel top-k by perturbed A-star.

The lattice of a text has its characters as nodes and the model's pieces as edges. A space is the mark
U+2581, a mark stands before the text, pieces hold marks only in front (runs of spaces are pieces too), and a character that is no
piece (and a literal U+2581) is one edge of byte pieces, so every text has a segmentation and decoding gives
back the text itself. The pieces are a public vocabulary; the piece of rank r weighs
1 / (r + RANK_0), and the probability of a segmentation is proportional to the product of its weights.

Summed weights to the end of each word (``beta``) turn edge weights into conditional probabilities:
a walk from the start that draws an edge per node is an exact sample. Sampling k distinct segmentations is A-star
over regions of the lattice. Every region has a Gumbel whose location is the region's log
probability; it equals the largest perturbed log probability in it. The root is all segmentations. The
region with the largest value is taken, a walk draws its segmentation, and what is left of it splits by the
first step that differs from that walk; the parts draw Gumbels truncated at their parent's value. The
k values taken are the k largest of all segmentations, in order, without visiting the others. With kappa the largest
value left, a sample's inclusion score is 1 - exp(-exp(log_prob - kappa)).

All randomness is counter-based on (row key, seed), so retries and other partitionings draw the same.
The lattices of all new words of a batch are built together in numpy and kept, up to
``cache`` edges, for later batches.

Defined results: null and empty texts have one segmentation, of no pieces; texts with fewer than k segmentations
return all of them; a null id takes its key from the text; repeated rows give repeated samples; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import M64, batches, column_of, mix64

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
TEXTS = 50          # texts that advance together
RANK_0 = 2.0
CACHE = 12_000_000  # edges of lattices a task keeps, 20 bytes each; a parameter that changes no result
MARK = "▁"

def load_pieces(model: str = MODEL) -> list[tuple[int, str, float]]:
    """(id, piece, score) of the ordinary pieces, and of the 256 byte pieces as '<0xNN>' with score None."""
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=model)
    out = []
    for i in range(p.get_piece_size()):
        s = p.id_to_piece(i)
        if p.is_byte(i):
            out.append((i, s, None))
        elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)) and MARK not in s.lstrip(MARK):
            out.append((i, s, float(p.get_score(i))))
    return out


def _spans(size: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)


class Lattice:
    """Pieces as a trie, and the lattices of the words met so far."""

    def __init__(self, pieces: list[tuple[int, str, float]], cache: int = CACHE):
        self.cache = cache
        self.byte_id = np.zeros(256, np.int32)
        self.table: dict[int, bytes] = {}
        plain = []
        for i, s, score in pieces:
            if score is None:
                self.byte_id[int(s[1:-1], 16)] = i
                self.table[i] = bytes([int(s[1:-1], 16)])
            else:
                plain.append((s, i))
                self.table[i] = s.replace(MARK, " ").encode()
        low = min((i for _, i in plain), default=0)
        states: dict[tuple[int, str], int] = {}
        final: dict[int, int] = {}
        for s, i in plain:
            at = 0
            for ch in s:
                at = states.setdefault((at, ch), len(states) + 1)
            final[at] = i
        self.final = np.full(len(states) + 1, -1, np.int64)
        for at, i in final.items():
            self.final[at] = i
        most = max(self.table, default=0) + 1
        self.spelled_size = np.fromiter((len(self.table.get(i, b"")) for i in range(most)), np.int64, most)
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size
        self.spelled = np.frombuffer(b"".join(self.table.get(i, b"") for i in range(most)), np.uint8)
        self.longest = max((len(s) for s, _ in plain), default=1)
        self.final_weight = -np.log(np.maximum(self.final - low, 0) + RANK_0)
        self.byte_weight = -np.log(len(plain) + RANK_0)
        bits = max(4, (4 * len(states)).bit_length())
        self.shift = 64 - bits
        self.slot_key, self.slot_to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        keys = np.array([(a << 21) | ord(c) for a, c in states], np.int64)
        for key, at, to in zip(keys.tolist(), self._hash(keys).tolist(), states.values()):
            while self.slot_key[at] >= 0:
                at = (at + 1) & ((1 << bits) - 1)
            self.slot_key[at], self.slot_to[at] = key, to
        self.clear()

    def clear(self) -> None:
        self.types: dict[str, int] = {}              # word -> its first slot
        self.slots = 0
        self.room: dict[str, np.ndarray] = {}
        self.edges = np.empty(0, np.uint8)           # slot -> number of its edges
        self.reach = np.empty(0, np.float32)         # probability of the node's edges up to this one
        self.start = np.empty(0, np.int32)           # slot -> first edge
        self.next = np.empty(0, np.int32)            # edge -> slot it leads to, -1 at the word's end
        self.logq = np.empty(0)
        self.piece = np.empty(0, np.int32)           # edge -> piece id, or -1 - code point

    def add(self, words: list[str]) -> None:
        """Build the lattices of new words."""
        if not words:
            return
        # A word of n characters has n + 1 slots; the last one is its end.
        chars = [w if w[:1] == "\n" else " " + w for w in words]
        size = np.fromiter(map(len, chars), np.int64, len(words))
        code = np.frombuffer("".join(chars).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        first = np.cumsum(size + 1) - size - 1
        slot = np.repeat(first, size) + _spans(size)
        left = np.repeat(size, size) - _spans(size)   # characters to the end of the word
        mark = ord(MARK)
        at_first = left == np.repeat(size, size)
        # Spaces are marks; a literal mark has no transitions.
        code_key = np.where(code == mark, 1 << 20 | 0xFFFFF, np.where(code == 32, mark, code))
        # Rows are characters by their distance from the word's end, so that beta runs over slices.
        # Column wide - l of a row: the edge of l characters, so that the longest, the likely ones, come first.
        at_text = np.argsort(left.astype(np.uint16) if left.max() < 1 << 16 else left, kind="stable")
        left, slot, code, at_first = left[at_text], slot[at_text], code[at_text], at_first[at_text]
        live, state, found = np.arange(len(code)), np.zeros(len(code), np.int64), []
        for l in range(self.longest):
            from_ = int(np.searchsorted(left[live], l, "right"))
            live, state = live[from_:], state[from_:]
            state = self._step(state, code_key[at_text[live] + l])
            on = state >= 0
            live, state = live[on], state[on]
            if not len(live):
                break
            hit = self.final[state] >= 0
            found.append((live[hit], l, state[hit]))
        wide = 1 + max((l for at, l, _ in found if len(at)), default=0)
        weight = np.full((len(code), wide), -np.inf)
        piece = np.zeros((len(code), wide), np.int32)
        for at, l, st in found:
            if len(at):
                weight[at, wide - 1 - l], piece[at, wide - 1 - l] = self.final_weight[st], self.final[st]
        lone = np.flatnonzero(weight[:, -1] == -np.inf)
        real = np.where((code == 32) & at_first, mark, code)[lone]
        weight[lone, -1] = (1 + (real > 0x7F) + (real > 0x7FF) + (real > 0xFFFF)) * self.byte_weight
        piece[lone, -1] = -1 - real
        beta = np.zeros(len(code) + len(words))
        reach = np.empty(weight.shape, np.float32)
        bounds = [0, *(np.flatnonzero(np.diff(left)) + 1).tolist(), len(code)]
        for a, b in zip(bounds, bounds[1:]):
            m = min(int(left[a]), wide)
            val = weight[a:b, wide - m:]
            val += beta[slot[a:b, None] + np.arange(m, 0, -1)]
            top = val.max(1)
            # Sums run from the longest edge to the shortest; a wider batch puts zeros in front, which change no bit.
            sums = np.cumsum(np.exp(val - top[:, None]), axis=1)
            np.divide(sums, sums[:, -1:], out=reach[a:b, wide - m:])
            beta[slot[a:b]] = total = top + np.log(sums[:, -1])
            val -= total[:, None]      # now log probabilities
        real = np.flatnonzero(weight.ravel() > -np.inf)
        row = real // wide
        count = np.bincount(row, minlength=len(code))
        reach, logq, piece = reach.ravel()[real], np.minimum(weight.ravel()[real], 0.0), piece.ravel()[real]
        ln = wide - (real - row * wide)
        dst = slot[row] + ln
        head = np.cumsum(count) - count
        reach[head + count - 1] = 1.0
        logq[head[count == 1]] = 0.0
        base, n = self.slots, len(self.next)
        start = np.full(len(beta), -1, np.int32)
        start[slot] = head + n
        for word, f in zip(words, first.tolist()):
            self.types[word] = base + f
        self._put("start", start)
        self._put("reach", reach)
        fan = np.zeros(len(beta), np.uint8)
        fan[slot] = count
        self._put("edges", fan)
        self._put("next", np.where(left[row] == ln, -1, dst + base))
        self._put("logq", logq)
        self._put("piece", piece)
        self.slots += len(beta)

    def _put(self, name: str, values: np.ndarray) -> None:
        """Append to an array that grows by a quarter."""
        old = getattr(self, name)
        buf, n = self.room.get(name, old), len(old)
        if n + len(values) > len(buf):
            buf = np.empty(n + len(values) + n // 4, old.dtype)
            buf[:n] = old
            self.room[name] = buf
        buf[n:n + len(values)] = values
        setattr(self, name, buf[:n + len(values)])

    def _step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The trie's next states, -1 where there is none (open addressing)."""
        key = (state << 21) | code
        out = np.full(len(key), -1, np.int64)
        todo, at = np.arange(len(key)), self._hash(key)
        while len(todo):
            found = self.slot_key[at]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_to[at[hit]]
            on = ~hit & (found >= 0)
            todo, at = todo[on], (at[on] + 1) & (len(self.slot_key) - 1)
        return out

    def _hash(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def slots_of(self, words: list[str]) -> np.ndarray:
        """First slots of the words; new words are built first."""
        if len(self.next) > self.cache:
            self.clear()
        out = np.fromiter(map(self.types.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(out < 0)
        if len(new):
            missing = [words[i] for i in new.tolist()]
            self.add(list(dict.fromkeys(missing)))
            out[new] = list(map(self.types.__getitem__, missing))
        return out

    def edges_of(self, slot: int) -> range:
        return range(self.start[slot], self.start[slot] + self.edges[slot])

    def walk(self, slots: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sample a path through each word from its slot (-1: nothing left). ``key``: a uint64 per word.
        Returns the edges in text order and how many each word has."""
        n = len(slots)
        live = np.flatnonzero(slots >= 0)
        node, steps, taken = slots[live], np.zeros(n, np.int64), []
        k, step = key[live], 0
        with np.errstate(over="ignore"):
            while len(live):
                u = _uniform(k, step)
                e = self.start[node]
                off = np.flatnonzero(u >= self.reach[e])
                while len(off):
                    e[off] += 1
                    off = off[u[off] >= self.reach[e[off]]]
                taken.append((live, e))
                steps[live] += 1
                node = self.next[e]
                on = node >= 0
                live, node, k = live[on], node[on], k[on]
                step += 1
        at = np.cumsum(steps) - steps
        out = np.empty(int(steps.sum()), np.int32)
        for s, (who, e) in enumerate(taken):
            out[at[who] + s] = e
        return out, steps

    def ids(self, edges: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of paths that follow each other, and where each begins and ends; a byte edge gives the pieces of its bytes."""
        p = self.piece[edges]
        raw = np.flatnonzero(p < 0)
        count = np.ones(len(p), np.int64)
        if not len(raw):
            return p, stop
        spelled = [chr(c).encode("utf-8", "surrogatepass") for c in (-1 - p[raw].astype(np.int64)).tolist()]
        count[raw] = [len(b) for b in spelled]
        out = np.repeat(p, count)
        ends = np.concatenate([[0], np.cumsum(count)])
        out[_spans(count[raw]) + np.repeat(ends[raw], count[raw])] = self.byte_id[np.frombuffer(b"".join(spelled), np.uint8)]
        return out, ends[stop]

    def spell(self, ids: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that sequences of ids decode to, the mark of the start included, and where each begins and ends."""
        size = self.spelled_size[ids]
        at = _spans(size) + np.repeat(self.spelled_at[ids], size)
        return self.spelled[at], np.concatenate([[0], np.cumsum(size)])[stop]

    def decode(self, ids) -> str:
        """The text of a sequence of piece ids."""
        return b"".join(map(self.table.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


def words_of(text: str) -> list[str]:
    """The parts of a text that no piece crosses: a word, with the spaces before it but one, stands for the mark and itself; one that
    begins with a line feed stands for itself alone (no piece holds a line feed)."""
    first, *lines = text.split("\n")
    out = _with_spaces(first.split(" "))
    for line in lines:
        parts = line.split(" ")
        parts[0] = "\n" + parts[0]
        out += _with_spaces(parts)
    return out


def _with_spaces(parts: list[str]) -> list[str]:
    """The parts with the empty ones put as spaces before the next, those at the end together."""
    if "" not in parts:
        return parts
    out, gap = [], 0
    for p in parts:
        if p:
            out.append(" " * gap + p)
            gap = 0
        else:
            gap += 1
    if gap:
        out.append(" " * (gap - 1))
    return out


def _uniform(key: np.ndarray, step: int) -> np.ndarray:
    """One number in (0, 1) per (well mixed) key and step."""
    with np.errstate(over="ignore"):
        x = (key + np.uint64(step)) * np.uint64(0xD1342543DE82EF95)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xAF251AF3B0F025B5)
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * (1.0 / (1 << 52))


def _keys(roots: np.ndarray, stream: int, sizes: np.ndarray, first: np.ndarray | int = 0) -> np.ndarray:
    """Keys of the items first, first + 1, ... of each root, one root after another."""
    with np.errstate(over="ignore"):
        r = mix64(roots + np.uint64(stream) * np.uint64(0x9E3779B97F4A7C15))
        at = (_spans(sizes) + np.repeat(np.broadcast_to(first, sizes.shape), sizes)).astype(np.uint64)
        x = (np.repeat(r, sizes) + at * np.uint64(0xD1B54A32D192ED03))
        return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


def _less(value: np.ndarray, mass: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbels located at ``mass``, truncated at ``value``."""
    with np.errstate(divide="ignore"):
        g = -np.logaddexp(-value, np.log(-np.log(u)) - mass)
    return np.where(mass == -np.inf, -np.inf, g)


class Paths:
    """One taken segmentation of each of some texts, with the regions that it leaves.

    Text i has the steps ``stop[i]:stop[i + 1]``. ``first[i]`` is the step where the segmentation left
    the one it comes from and ``left[i]`` the probability there of the edges that neither took."""

    def __init__(self, lattice: Lattice, keys: np.ndarray, stream: int, edges, word, stop, value, first=None, left=None):
        self.edges, self.word, self.stop, self.value = edges, word, stop, value
        logq = lattice.logq[edges]
        size = np.diff(stop)
        acc = np.empty(len(logq))
        for a, b in zip(stop[:-1].tolist(), stop[1:].tolist()):
            np.cumsum(logq[a:b], out=acc[a:b])
        self.log_prob = acc[stop[1:] - 1]
        before = acc - logq
        with np.errstate(divide="ignore"):
            mass = before + np.log(np.maximum(0.0, -np.expm1(logq)))
            if first is not None:
                # Before the step everything belongs to the segmentation that was left.
                at = stop[:-1] + first
                prefix = before[at]
                mass[_spans(size) < np.repeat(first, size)] = -np.inf
                mass[at] = prefix + np.log(np.where(left > 1e-12, left, 0.0))
        self.gumbel = _less(np.repeat(value, size), mass, _uniform(_keys(keys, stream, size), 0))

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """The largest region of each text: its step and value."""
        top = np.maximum.reduceat(self.gumbel, self.stop[:-1])
        at = np.flatnonzero(self.gumbel == np.repeat(top, np.diff(self.stop)))
        owner = np.searchsorted(self.stop, at, "right") - 1
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        return at[first] - self.stop[:-1], top


def sample_batch(lattice: Lattice, slots: np.ndarray, sizes: np.ndarray, keys: np.ndarray, k: int):
    """For texts of at least one word (their words' slots one after another): the taken segmentations as a list of
    (texts, Paths), by falling value, and kappa of each text. All texts advance together."""
    n = len(sizes)
    begin = np.cumsum(sizes) - sizes
    edges, steps = lattice.walk(slots, _keys(keys, 4, sizes))
    word = np.repeat(_spans(sizes), steps)
    stop = np.concatenate([[0], np.cumsum(np.add.reduceat(steps, begin))])
    value = -np.log(-np.log(_uniform(_keys(keys, 1, np.ones(n, np.int64)), 0)))
    layers = [(np.arange(n), Paths(lattice, keys, 2, edges, word, stop, value))]
    banned: list[dict[tuple, list[int]]] = [{} for _ in range(n)]    # (prefix, step) -> edges taken there
    kappa = np.full(n, -np.inf)
    for turn in range(1, k + 1):
        # The largest region of each text over the segmentations taken so far.
        kappa, layer, step = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for j, (who, p) in enumerate(layers):
            at, top = p.best()
            up = top > kappa[who]
            kappa[who[up]], layer[who[up]], step[who[up]] = top[up], j, at[up]
        open_ = np.flatnonzero(kappa > -np.inf)
        if turn == k or not len(open_):
            break
        parts = []
        for j, (who, p) in enumerate(layers):
            mine = open_[layer[open_] == j]
            if len(mine):
                row = np.searchsorted(who, mine)
                t = step[mine]
                pos = p.stop[row] + t
                p.gumbel[pos] = -np.inf
                inside = (t > 0) & (p.word[pos - 1] == p.word[pos])   # not the first step of its word
                node = np.where(inside, lattice.next[p.edges[pos - 1]], slots[begin[mine] + p.word[pos]])
                parts.append((mine, p, row, t, p.edges[pos], p.word[pos], node))
        mine, t, old, at_word, node = (np.concatenate([x[c] for x in parts]) for c in (0, 3, 4, 5, 6))
        prefix = [p.edges[a:a + b] for _, p, row, tt, *_ in parts for a, b in zip(p.stop[row].tolist(), tt.tolist())]
        pre_word = [p.word[a:a + b] for _, p, row, tt, *_ in parts for a, b in zip(p.stop[row].tolist(), tt.tolist())]
        back = np.argsort(mine)
        mine, t, old, at_word, node = mine[back], t[back], old[back], at_word[back], node[back]
        prefix, pre_word = [prefix[i] for i in back.tolist()], [pre_word[i] for i in back.tolist()]
        # Another edge out of the same node, by the probabilities without those already taken there.
        u = _uniform(_keys(keys[mine], 10 * turn + 3, np.ones(len(mine), np.int64)), 0)
        new, left = np.empty(len(mine), np.int64), np.empty(len(mine))
        for x, (i, tt, e, v) in enumerate(zip(mine.tolist(), t.tolist(), old.tolist(), node.tolist())):
            gone = banned[i].setdefault((tuple(prefix[x].tolist()) if k > 2 else 0, tt), [])
            gone.append(e)
            rest = [y for y in lattice.edges_of(v) if y not in gone]
            w = np.cumsum(np.exp(lattice.logq[rest]))
            c = min(len(rest) - 1, int(np.searchsorted(w, u[x] * w[-1])))
            new[x] = rest[c]
            left[x] = sum(np.exp(lattice.logq[y]) for y in rest if y != rest[c])
        ahead_n = sizes[mine] - at_word
        where = _spans(ahead_n) + np.repeat(begin[mine] + at_word, ahead_n)
        ahead = slots[where]
        ahead[np.cumsum(ahead_n) - ahead_n] = lattice.next[new]
        tail, more = lattice.walk(ahead, _keys(keys[mine], 10 * turn + 4, ahead_n, at_word))
        tail_n = np.add.reduceat(more, np.cumsum(ahead_n) - ahead_n)
        tail_word = np.repeat(_spans(ahead_n) + np.repeat(at_word, ahead_n), more)
        cuts = np.concatenate([[0], np.cumsum(tail_n)]).tolist()
        e_parts, w_parts = [], []
        for x, (e, w) in enumerate(zip(prefix, pre_word)):
            e_parts += [e, new[x:x + 1], tail[cuts[x]:cuts[x + 1]]]
            w_parts += [w, at_word[x:x + 1], tail_word[cuts[x]:cuts[x + 1]]]
        p = Paths(lattice, keys[mine], 10 * turn + 5, np.concatenate(e_parts), np.concatenate(w_parts),
                  np.concatenate([[0], np.cumsum(t + 1 + tail_n)]), kappa[mine], t, left)
        layers.append((mine, p))
    return layers, kappa


_OUT = pa.schema([("doc_id", pa.int64()), ("sample", pa.int32()), ("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()),
                  ("log_prob", pa.float64()), ("gumbel", pa.float64()), ("inclusion", pa.float64()),
                  ("round_trip", pa.bool_())])
_DDL = ("doc_id bigint, sample int, ids array<int>, n_pieces bigint, log_prob double, gumbel double, inclusion double, "
        "round_trip boolean")


def encode_batches(lattice: Lattice, ids: list, texts: list[str], k: int, seed: int):
    """Record batches of the samples of some texts: all first ones, all second ones, ..."""
    roots = [i if i is not None else int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
             for i, t in zip(ids, texts)]
    with np.errstate(over="ignore"):
        keys = mix64(np.array([r & M64 for r in roots], np.uint64) ^ np.uint64(seed * 0xD1B54A32D192ED03 & M64))
    empty = [j for j, t in enumerate(texts) if not t]
    if empty:
        value = -np.log(-np.log(_uniform(keys[empty], 0)))
        yield from batches(((ids[j], 1, [], 0, 0.0, v, 1.0, True) for j, v in zip(empty, value.tolist())), _OUT)
    full = [j for j, t in enumerate(texts) if t]
    if not full:
        return
    words = [words_of(texts[j]) for j in full]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    layers, kappa = sample_batch(lattice, lattice.slots_of(list(chain.from_iterable(words))), sizes, keys[full], k)
    source = [(" " + texts[j]).encode("utf-8", "surrogatepass") for j in full]
    for turn, (who, p) in enumerate(layers):
        pieces, stop = lattice.ids(p.edges, p.stop)
        spelled, ends = lattice.spell(pieces, stop)
        with np.errstate(over="ignore"):
            inclusion = np.where(kappa[who] > -np.inf, -np.expm1(-np.exp(np.minimum(50.0, p.log_prob - kappa[who]))), 1.0)
        trip = [spelled[a:b].tobytes() == source[i] for i, a, b in zip(who.tolist(), ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays([
            pa.array([ids[full[i]] for i in who.tolist()], pa.int64()), pa.array(np.full(len(who), turn + 1, np.int32)),
            pa.ListArray.from_arrays(pa.array(stop.astype(np.int32)), pa.array(pieces.astype(np.int32, copy=False))),
            pa.array(np.diff(stop)), pa.array(p.log_prob), pa.array(p.value), pa.array(inclusion), pa.array(trip, pa.bool_())], schema=_OUT)


def encode_rows(lattice: Lattice, ids: list, texts: list[str], k: int = SAMPLES, seed: int = 0) -> list[dict]:
    """The same as rows, for callers with a few texts."""
    return [r for b in encode_batches(lattice, ids, texts, k, seed) for r in b.to_pylist()]


def sample_segmentations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES, seed: int = 0,
                         model: str = MODEL, cache: int = CACHE) -> DataFrame:
    """Up to k rows per document: doc_id, sample (1 = largest value), ids, n_pieces, log_prob, gumbel (the
    perturbed log probability), inclusion, round_trip (decoding gives back the text)."""
    pieces = load_pieces(model)   # 32,000 short strings; executors need no file

    def run(it):
        lattice = Lattice(pieces, cache)

        for b in it:
            ids, texts = column_of(b, "id"), column_of(b, "t")
            for a in range(0, len(ids), TEXTS):
                yield from encode_batches(lattice, ids[a:a + TEXTS], texts[a:a + TEXTS], k, seed)

    return (docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
            .mapInArrow(run, _DDL))
