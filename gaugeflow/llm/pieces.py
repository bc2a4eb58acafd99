"""SentencePiece encoding by Gumbel top-k without replacement, and decoding.

A text has as many segmentations as its lattice of vocabulary pieces has paths.
A path's probability is the product of its pieces' weights, a Zipf law over the
merge ranks of the vocabulary to the power ``alpha``, normalised over the lattice
by its backward sums. ``sample`` returns the ``k`` segmentations with the largest
Gumbel-perturbed log-probabilities, which is sampling without replacement.

The search is best-first (A-star) over lattice nodes. A node's bound is the largest
perturbed value among the paths through it, drawn top-down: the root's is
Gumbel(0), and the children of a node get Gumbels conditioned on their maximum
being the node's. The bound is reached by one of the paths, so the order in which
nodes are taken up is exact and the first k paths that are complete are the
sample. The best bound left over is the threshold for the inclusion scores: the
log of the chance that a segmentation's perturbed value exceeds it.

Far down a long text a node's mass is tiny and its siblings hardly ever count.
From ``FAR`` on, the best path of a node is drawn at once, as a path of the lattice
given the node, and the other paths of the node become one remainder with its
own bound, taken up again only if its turn comes. This changes nothing in the
distribution. Those draws are done for all words of a batch together.

No piece crosses from a word into the blank after it, so the lattice of a text is
a chain of the lattices of its words (and of what else no piece crosses). A different
word, known by a 64-bit hash, is laid out once and kept for the texts that follow.
Texts without blanks are a word of any length: beyond ``LONG`` characters its sums are formed
node by node, and the rest of a path is drawn by an edge for each node that is left.
Numbers are seeded by the row's key: they don't depend on batches or order.
"""

from __future__ import annotations

import heapq
import math
import random
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from gaugeflow.llm.common import name, type_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
FAR = -3.0
POWER = 0x2545F4914F6CDD1D
NEAR_END = 8  # with fewer words left, and none of them long, a node's children are drawn one by one
LONG = 256  # characters, or steps of a draw, from which on a word is worked on by itself
END = "\x00"
STOPS = ".,;:!?)\""
BATCH_CHARS = 1 << 18
NODES = 1 << 20  # lattice nodes a task keeps between batches
KEPT = 1 << 19  # of these, nodes that stay: those laid out first, frequent words among them


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id with blanks as spaces, ids of the 256 bytes, and log-weights."""

    pieces: dict[str, int]
    bytes_: list[int]
    rank: dict[int, int]
    table: list[bytes]
    cut_blank: bool  # no piece goes on from a character into a blank
    cut_line: bool  # no piece holds a line end
    held: dict[str, int]  # per character the stops (as bits) that some piece holds behind it


def vocabulary(model: str = MODEL) -> Vocabulary:
    """Read a SentencePiece model file (on the driver; tasks get the pieces)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, bytes_, rank, table = {}, [0] * 256, {}, [b""] * sp.get_piece_size()
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            bytes_[int(piece[3:5], 16)] = i
            table[i] = bytes([int(piece[3:5], 16)])
        else:
            text = piece.replace(BLANK, " ")
            pieces[text], table[i] = i, text.encode()
    # runs of blanks and the like have no rank of their own: they come first
    order = sorted(pieces.values(), key=lambda i: (-sp.get_score(i) if sp.get_score(i) > -1e8 else 0, i))
    rank = {i: n for n, i in enumerate(order)}
    inside = {t[i : i + 2] for t in pieces for i in range(len(t) - 1)}
    held: dict[str, int] = {}
    for pair in inside:
        if pair[1] in STOPS:
            held[pair[0]] = held.get(pair[0], 0) | 1 << STOPS.index(pair[1])
    cut_blank = not any(p[1] == " " != p[0] for p in inside)
    return Vocabulary(pieces, bytes_, rank, table, cut_blank, not any("\n" in p for p in inside), held)


def decode_ids(ids, table: list[bytes]) -> str:
    """The text of a segmentation; the blank put before the text goes."""
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


class Growing:
    """An array that is added to at its end, and cut there."""

    def __init__(self, kind) -> None:
        self.data, self.size = np.empty(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if (need := self.size + len(more)) > len(self.data):
            data = np.empty(max(need, len(self.data) * 3 // 2), self.data.dtype)
            data[: self.size] = self.data[: self.size]
            self.data = data
        self.data[self.size : need] = more
        self.size = need


class Lattice:
    """The lattices of words, laid out one behind the other in arrays that grow.

    Nodes are places between characters. Edges are sorted by the node they start
    from; ``upto`` is the summed probability of its edges up to this one, given the
    node.
    """

    def __init__(self, v: Vocabulary, alpha: float) -> None:
        self.v = v
        # beginnings of pieces by hash: the piece that is one, else -1
        begun = {t[:n]: -1 for t in v.pieces for n in range(1, len(t) + 1)} | v.pieces
        texts = list(begun)
        keys = np.zeros(len(texts), np.uint64)
        for n in range(max(map(len, texts))):
            own = np.array([i for i, t in enumerate(texts) if len(t) > n], np.int64)
            keys[own] = _longer(keys[own], np.array([ord(texts[i][n]) for i in own.tolist()], np.uint64))
        by = np.argsort(keys)
        self.begun, self.piece = keys[by], np.fromiter(begun.values(), np.int64, len(texts))[by]
        # where keys with the same first bits stand; one more key that nothing equals ends the search
        self.begun, self.piece = np.append(self.begun, np.uint64((1 << 64) - 1)), np.append(self.piece, -1)
        self.slot = np.searchsorted(self.begun, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        self.held = np.zeros(max(map(ord, v.held), default=0) + 2, np.uint8)
        for c, bits in v.held.items():
            self.held[ord(c)] = bits
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.weight = np.zeros(len(v.table))
        for i, n in v.rank.items():
            self.weight[i] = -alpha * math.log(n + 2.7)
        self.byte_weight = -alpha * math.log(len(v.rank) + 2.7)
        self.clear()

    def clear(self) -> None:
        self.start: dict[int, int] = {}  # first node by the hash of a word
        self.nodes = 0
        self.columns = [Growing(k) for k in (bool, np.int32, np.int32, np.float32, np.float32, np.int32, np.int32, np.int32)]
        self.columns[1].add(np.zeros(1, np.int32))
        self._show()

    def _show(self) -> None:
        """``final``: nodes at which a word ends. ``first``: first edge of a node, and one more. Of edges: the node
        they lead to, ``upto``, log-probability, place and number of their ids in ``ids``."""
        self.final, self.first, self.to, self.upto, self.logp, self.at, self.n, self.ids = (c.data for c in self.columns)

    def trim(self) -> None:
        """Forget the words laid out last."""
        if self.nodes <= NODES:
            return
        ends = np.flatnonzero(self.final[:KEPT])
        if not len(ends):
            return self.clear()
        self.nodes = int(ends[-1]) + 1
        edges = int(self.first[self.nodes])
        ids = int((self.at[:edges] + self.n[:edges]).max(initial=0))
        for c, size in zip(self.columns, (self.nodes, self.nodes + 1, *[edges] * 5, ids), strict=True):
            c.size = size
        self.start = {w: at for w, at in self.start.items() if at < self.nodes}

    def starts(self, texts: list[str]) -> list[np.ndarray]:
        """The first node of each word of each text; lays out the words that aren't there yet."""
        whole = "".join([" " + t for t in texts if t])
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        ends = np.cumsum(sizes)
        if not whole:
            return [np.empty(0, np.int64) for _ in texts]
        chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        cut = self._cuts(chars)
        cut[(ends - sizes)[sizes > 0]] = True
        low = np.flatnonzero(cut)
        high = np.append(low[1:], len(chars))
        keys, first, which = np.unique(self._hashes(chars, low, high), return_index=True, return_inverse=True)
        known = self.start.get
        nodes = np.array([known(k, -1) for k in keys.tolist()], np.int64)
        if len(new := np.flatnonzero(nodes < 0)):
            at = first[new]
            nodes[new] = self._lay([whole[a:b] for a, b in zip(low[at].tolist(), high[at].tolist(), strict=True)])
            self.start.update(zip(keys[new].tolist(), nodes[new].tolist(), strict=True))
        return np.split(nodes[which], np.searchsorted(low, ends[:-1]))

    def _cuts(self, chars: np.ndarray) -> np.ndarray:
        """Whether a word begins at a character: before blanks, around line ends, before stops; where no piece crosses."""
        cut = np.zeros(len(chars), bool)
        before, here = chars[:-1], chars[1:]
        if self.v.cut_blank:
            cut[1:] = (here == 32) & (before != 32)
            if self.v.cut_line:
                cut[1:] |= (here == 10) | (before == 10)
        for k, stop in enumerate(STOPS):
            at = np.flatnonzero(here == ord(stop))
            held = self.held[np.minimum(before[at], len(self.held) - 1)] >> k & 1
            cut[1 + at[held == 0]] = True
        return cut

    def _hashes(self, chars: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """64-bit hashes of stretches: sums of characters times powers, shifted to the stretch's beginning."""
        while len(self.power) <= len(chars):
            for name_, base in (("power", POWER), ("inverse", pow(POWER, -1, 1 << 64))):
                old = getattr(self, name_)
                setattr(self, name_, np.concatenate([old, old * np.uint64(pow(base, len(old), 1 << 64))]))
        c = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        c ^= c >> np.uint64(29)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c * self.power[: len(c)])])
        x = (sums[high] - sums[low]) * self.inverse[low] + (high - low).astype(np.uint64)
        return (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)

    def _lay(self, new: list[str]) -> np.ndarray:
        text = END.join(new) + END
        lengths = np.array([len(w) for w in new], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
        base = self.nodes
        size = len(text)
        low, high, piece = self._matches(text)
        weight = self.weight[piece]
        # characters without a piece of their own are written as bytes
        lone = np.ones(size, bool)
        lone[low[high - low == 1]] = False
        ends = offsets + lengths
        lone[ends] = False
        where = np.flatnonzero(lone)
        raw = [text[i].encode("utf-8", "surrogatepass") for i in where.tolist()]
        count = np.array([len(b) for b in raw], np.int64)
        ids = np.concatenate([piece, np.array([self.v.bytes_[x] for b in raw for x in b], np.int64)]).astype(np.int32)
        at = np.concatenate([np.arange(len(piece)), len(piece) + np.cumsum(count) - count]).astype(np.int64)
        n = np.concatenate([np.ones(len(piece), np.int64), count])
        low, high = np.concatenate([low, where]), np.concatenate([high, where + 1])
        weight = np.concatenate([weight, count * self.byte_weight])
        # backward sums, nodes at equal distance from their word's end together
        by = np.argsort(low, kind="stable")
        low, high, weight, at, n = low[by], high[by], weight[by], at[by], n[by]
        left = (np.repeat(ends, lengths + 1) - np.arange(size))[low]
        by = np.argsort(left.astype(np.uint16) if len(left) and left.max() < 1 << 16 else left, kind="stable")
        sums = np.zeros(size)
        starts = np.flatnonzero(np.r_[True, np.diff(low[by]) != 0]) if len(by) else by
        node = low[by][starts]
        step = left[by][starts]
        cuts = np.flatnonzero(np.r_[True, np.diff(step) != 0]) if len(node) else starts
        bounds = [*cuts.tolist(), len(node)]
        edge_bounds = np.r_[starts, len(by)]
        to, w = high[by], weight[by]
        far = int(np.searchsorted(step, LONG, "right"))
        bounds = [x for x in bounds if x < far] + [far]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            lo, hi = edge_bounds[a], edge_bounds[b]
            sums[node[a:b]] = np.logaddexp.reduceat(w[lo:hi] + sums[to[lo:hi]], starts[a:b] - lo)
        _sum_each(sums, node, edge_bounds, to, w, far)
        logp = weight + sums[high] - sums[low]
        per = np.bincount(low, minlength=size)
        first = np.cumsum(per) - per
        upto, turn = np.exp(logp), np.arange(len(low)) - first[low]
        for k in range(1, int(per.max(initial=0))):  # summed node by node: the same wherever a word stands
            more = np.flatnonzero(turn == k)
            upto[more] += upto[more - 1]
        upto = upto.astype(np.float32)
        upto[(first + per - 1)[per > 0]] = 2.0  # the last edge of each node closes it
        final, starts, *rest, held = self.columns
        old = rest[0].size
        last = np.zeros(size, bool)
        last[ends] = True
        final.add(last)
        starts.size -= 1
        starts.add(np.append(old + first, old + len(low)))
        for c, x in zip(rest, (base + high, upto, logp, held.size + at, n), strict=True):
            c.add(x)
        held.add(ids)
        self._show()
        self.nodes += size
        return base + offsets

    def _matches(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All places of pieces: (from, to, id). All starts are lengthened together while a piece begins so."""
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        at, key, n, out = np.arange(len(chars)), np.zeros(len(chars), np.uint64), 0, []
        while len(at):
            key = _longer(key, chars[at + n])
            n += 1
            place = self.slot[key >> np.uint64(44)]
            low = np.flatnonzero(self.begun[place] < key)
            while len(low):
                place[low] += 1
                low = low[self.begun[place[low]] < key[low]]
            on = np.flatnonzero(self.begun[place] == key)
            at, key, piece = at[on], key[on], self.piece[place[on]]
            whole = np.flatnonzero(piece >= 0)
            out.append((at[whole], at[whole] + n, piece[whole]))
            more = np.flatnonzero(at + n < len(chars))
            at, key = at[more], key[more]
        low, high, piece = (np.concatenate(x) for x in zip(*out, strict=True))
        return low, high, piece

    def draw(self, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path from each node to the end of its word: (which word, edge) in order of the words."""
        at, which, edges, turns = node.copy(), [], [], []
        live = np.flatnonzero(~self.final[at])
        at, seed = at[live], seed[live]
        turn = 0
        while len(live) and turn < LONG:
            turn += 1
            turns.append(np.full(len(live), turn))
            u = _uniform(seed + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).astype(np.float32)
            e = self.first[at]
            on = np.flatnonzero(self.upto[e] <= u)
            while len(on):
                e[on] += 1
                on = on[self.upto[e[on]] <= u[on]]
            which.append(live)
            edges.append(e)
            at = self.to[e]
            stay = np.flatnonzero(~self.final[at])
            live, at, seed = live[stay], at[stay], seed[stay]
        for w, n, x in zip(live.tolist(), at.tolist(), seed, strict=True):
            edges.append(self._walk(n, x))
            which.append(np.full(len(edges[-1]), w))
            turns.append(np.arange(turn + 1, turn + 1 + len(edges[-1])))
        if not edges:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        which, edges, turns = np.concatenate(which), np.concatenate(edges), np.concatenate(turns)
        # the turns are in order each: place of a draw is that of its word and its turn
        per = np.bincount(which, minlength=len(node))
        place = (np.cumsum(per) - per)[which] + turns - 1
        out, word = np.empty(len(edges), np.int64), np.empty(len(edges), np.int64)
        out[place], word[place] = edges, which
        return word, out

    def _walk(self, node: int, seed: np.uint64) -> np.ndarray:
        """A path from a node to the end of its word: an edge is drawn for each node that is left, those on the way are taken."""
        left = int(np.argmax(self.final[node:]))
        turn = np.arange(LONG + 1, LONG + 1 + left, dtype=np.uint64)
        u = _uniform(seed + turn * np.uint64(0x9E3779B97F4A7C15)).astype(np.float32)
        e = self.first[node : node + left].astype(np.int64)
        on = np.flatnonzero(self.upto[e] <= u)
        while len(on):
            e[on] += 1
            on = on[self.upto[e[on]] <= u[on]]
        to, at, path = (self.to[e] - node).tolist(), 0, []
        while at < left:
            path.append(at)
            at = to[at]
        return e[path]

    def long_from(self, node: int) -> bool:
        """Whether the word goes on for ``LONG`` characters."""
        return not self.final[node : node + LONG].any()

    def spelled(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of edges one behind the other, and how many each has."""
        n = self.n[edges]
        ends = np.cumsum(n)
        flat = np.repeat(self.at[edges] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[flat], n


def _sum_each(sums: np.ndarray, node: np.ndarray, bounds: np.ndarray, to: np.ndarray, weight: np.ndarray, first: int) -> None:
    """Backward sums of the nodes from the ``first`` on, one after the other."""
    value = memoryview(sums)
    for a in range(first, len(node), 1 << 16):
        nodes = node[a : a + (1 << 16)].tolist()
        ends = bounds[a : a + len(nodes) + 1]
        lo, hi = int(ends[0]), int(ends[-1])
        towards, weights, at = to[lo:hi].tolist(), weight[lo:hi].tolist(), 0
        for x, end in zip(nodes, (ends[1:] - lo).tolist(), strict=True):
            if end == at + 1:
                value[x] = weights[at] + value[towards[at]]
            else:
                terms = [weights[i] + value[towards[i]] for i in range(at, end)]
                most = max(terms)
                value[x] = most + math.log(sum([math.exp(t - most) for t in terms]))
            at = end


def _longer(key: np.ndarray, char: np.ndarray) -> np.ndarray:
    """The hash of a text with one more character."""
    x = (key + char + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _uniform(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def _gumbel(rng: random.Random, location: float) -> float:
    return location - math.log(-math.log(rng.random() or 5e-324))


def _under(value: float, top: float, best: float) -> float:
    """A Gumbel given that the largest of its group, ``best`` as drawn, is ``top``."""
    d = value - best
    if d == 0:
        return top
    v = top - value + (math.log(-math.expm1(d)) if d < -1e-12 else math.log(-d))
    return top - max(0.0, v) - math.log1p(math.exp(-abs(v)))


@dataclass
class Search:
    """The state of the search in one text."""

    starts: np.ndarray  # node of each word
    rng: random.Random
    seed: int
    k: int
    agenda: list = field(default_factory=list)
    bounds: list[float] = field(default_factory=list)  # the k + 1 largest bounds pushed, smallest first
    turn: int = 0
    done: list = field(default_factory=list)  # (edges, log-probability, perturbed)

    def push(self, bound: float, *state) -> None:
        """Keep a node unless k + 1 others have larger bounds: those are taken up before it."""
        if len(self.bounds) > self.k and bound <= self.bounds[0]:
            return
        insort(self.bounds, bound)
        if len(self.bounds) > self.k + 1:
            del self.bounds[0]
        self.turn += 1
        heapq.heappush(self.agenda, (-bound, self.turn, *state))


def _descend(s: Search, lat: Lattice) -> tuple | None:
    """Take up the best node and follow its best child until a path is complete or FAR is reached."""
    minus, _, word, node, mass, path, without = heapq.heappop(s.agenda)
    top, first, to, logp, rng = -minus, lat.first, lat.to, lat.logp, s.rng
    n = len(s.starts)
    while word < n and not (mass < FAR and (n - word >= NEAR_END or lat.long_from(node))):
        lo, hi = int(first[node]), int(first[node + 1])
        if hi == lo + 1:
            best = lo
        else:
            masses = [mass + x for x in logp[lo:hi].tolist()]
            drawn = [_gumbel(rng, m) for m in masses]
            greatest = max(drawn)
            best = lo + drawn.index(greatest)
            for e in range(lo, hi):
                if e != best:
                    bound = _under(drawn[e - lo], top, greatest)
                    if len(s.bounds) <= s.k or bound > s.bounds[0]:
                        s.push(bound, *_next(s, lat, word, int(to[e])), masses[e - lo], (path, e), ())
            mass = masses[best - lo]
        path = (path, best)
        word, node = _next(s, lat, word, int(to[best]))
    if word == n:
        s.done.append((path, mass, top, None))
        return None
    return word, node, mass, path, top, without


def _next(s: Search, lat: Lattice, word: int, node: int) -> tuple[int, int]:
    if not lat.final[node]:
        return word, node
    return word + 1, int(s.starts[word + 1]) if word + 1 < len(s.starts) else -1


def search(texts: list[str], keys: list[int], lat: Lattice, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """Per text its samples, best first: (ids, log-probability, perturbed value, log inclusion score)."""
    states = []
    for starts, key in zip(lat.starts(texts), keys, strict=True):
        s = Search(starts, random.Random(key), key, k)
        if len(starts):
            s.push(_gumbel(s.rng, 0.0), 0, int(starts[0]), 0.0, None, ())
        states.append(s)
    for _ in range(k):
        waiting = [(s, got) for s in states if s.agenda and len(s.done) < k and (got := _descend(s, lat)) is not None]
        again = 0
        while waiting:  # more than once only where a path is drawn that the node has given already
            nodes = [np.concatenate([[g[1]], s.starts[g[0] + 1 :]]) for s, g in waiting]
            seeds = [
                (np.uint64(s.seed) + np.uint64(0xD1342543DE82EF95) * (np.arange(len(x), dtype=np.uint64) + np.uint64((len(s.done) << 40) + (again << 48))))
                for (s, _), x in zip(waiting, nodes, strict=True)
            ]
            sizes = [len(x) for x in nodes]
            which, edges = lat.draw(np.concatenate(nodes), np.concatenate(seeds))
            cut = np.searchsorted(which, np.cumsum([0, *sizes]))
            retry = []
            for (s, g), a, b in zip(waiting, cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                word, node, mass, path, top, without = g
                rest = edges[a:b]
                mark = rest.tobytes() if len(rest) < 64 else xxhash.xxh3_128_digest(rest.tobytes())
                if mark in without:
                    retry.append((s, g))
                    continue
                p = float(lat.logp[rest].sum(dtype=np.float64))
                s.done.append((path, mass + p if not without else _mass(path, lat) + p, top, rest))
                if p < -1e-12:
                    left = mass + (math.log(-math.expm1(p)) if p > -30 else 0.0)
                    g_left = _gumbel(s.rng, left)
                    bound = -_logaddexp(-top, -g_left)
                    s.push(bound, word, node, left, path, (*without, mark))
            waiting, again = retry, again + 1
    # ids of all samples at once
    done = [x for s in states for x in s.done]
    edges = [_edges(path) if rest is None else np.concatenate([_edges(path), rest]) for path, _, _, rest in done]
    ids, n = lat.spelled(np.concatenate([np.empty(0, np.int64), *edges]))
    ends = np.r_[0, np.cumsum(n)][np.cumsum([0, *map(len, edges)])].tolist()
    spelled = iter([ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
    return [_finish(s, spelled) for s in states]


def _edges(path: tuple | None) -> np.ndarray:
    """The edges of a path, which is kept as (the path before, its last edge): a step further costs no copy."""
    out = []
    while path is not None:
        path, edge = path
        out.append(edge)
    return np.array(out[::-1], np.int64)


def _mass(path: tuple | None, lat: Lattice) -> float:
    return float(lat.logp[_edges(path)].sum(dtype=np.float64)) if path is not None else 0.0


def _logaddexp(a: float, b: float) -> float:
    m = max(a, b)
    return m + math.log1p(math.exp(-abs(a - b)))


def _finish(s: Search, spelled: Iterator[np.ndarray]) -> list[tuple[np.ndarray, float, float, float]]:
    threshold = -s.agenda[0][0] if s.agenda else -math.inf
    out = []
    for _, p, top, _ in s.done:
        over = p - threshold
        inclusion = 0.0 if over > 36 else over if over < -36 else math.log(-math.expm1(-math.exp(over)))
        out.append((next(spelled), p, top, min(inclusion, 0.0)))
    if not len(s.starts):
        out.append((np.empty(0, np.int32), 0.0, 0.0, 0.0))
    return out


def sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, alpha: float = 0.3, seed: int = 6, model: str = MODEL
) -> DataFrame:
    """Up to ``k`` different segmentations of each row's text, best first.

    Columns: the id, ``sample`` (from 1), ``ids``, ``log_probability``,
    ``perturbed``, ``log_inclusion``, ``round_trip`` (whether the ids decode to
    the text). A text with fewer segmentations gives all of them, the empty and
    the null text one without ids. Rows that share an id and a text get the same
    samples. Texts are taken whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(vocabulary(model)))  # a vocabulary: some 32,000 pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(**sent.value)
        lat = Lattice(v, alpha)
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            at = 0
            while at < len(sizes):
                end, size = at, 0
                while end < len(sizes) and (end == at or size + sizes[end] < BATCH_CHARS):
                    size += sizes[end]
                    end += 1
                names, texts = b.column(0).slice(at, end - at), [t or "" for t in b.column(1).slice(at, end - at).to_pylist()]
                keys = [xxhash.xxh64_intdigest(str(i).encode(), seed) for i in names.to_pylist()]
                yield _batch(names, texts, search(texts, keys, lat, k), v.table)
                lat.trim()
                at = end

    schema = (
        f"`{id_col}` {type_of(docs, id_col)}, sample int, ids array<int>, log_probability double, perturbed double, "
        "log_inclusion double, round_trip boolean"
    )
    return docs.select(name(id_col), name(text_col).cast("string")).mapInArrow(run, schema)


def _round_trips(ids: np.ndarray, offsets: np.ndarray, texts: list[str], table: list[bytes]) -> list[bool]:
    """Whether the ids from offset to offset decode to the text; all are put together and compared at once."""
    sizes = np.array([len(x) for x in table], np.int64)
    begin = np.cumsum(sizes) - sizes
    n = sizes[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    written = np.frombuffer(b"".join(table), np.uint8)[np.repeat(begin[ids] - (ends - n), n) + np.arange(total)]
    want = b"".join([b" " + t.encode("utf-8", "surrogatepass") if t else b"" for t in texts])
    if want == written.tobytes():
        there = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 if t else 0 for t in texts])
        if (np.r_[0, ends][offsets[1:]] == there).all():
            return [True] * len(texts)
    return [decode_ids(ids[a:b].tolist(), table) == t for a, b, t in zip(offsets[:-1], offsets[1:], texts, strict=True)]


def _batch(ids: pa.Array, texts: list[str], got: list, table: list[bytes]) -> pa.RecordBatch:
    flat = [(i, n + 1, *x) for i, some in enumerate(got) for n, x in enumerate(some)]
    offsets = np.cumsum([0, *[len(x[2]) for x in flat]]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([x[2] for x in flat]).astype(np.int32)))
    right = _round_trips(lists.values.to_numpy(), offsets, [texts[x[0]] for x in flat], table)
    columns = [
        ids.take(pa.array([x[0] for x in flat], pa.int64())), pa.array([x[1] for x in flat], pa.int32()), lists,
        pa.array([x[3] for x in flat], pa.float64()), pa.array([x[4] for x in flat], pa.float64()),
        pa.array([x[5] for x in flat], pa.float64()), pa.array(right, pa.bool_()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "sample", "ids", "log_probability", "perturbed", "log_inclusion", "round_trip"])


def decode(df: DataFrame, ids_col: str = "ids", out: str = "text", model: str = MODEL) -> DataFrame:
    """``df`` with ``out``, the text of ``ids_col``: null for null, empty for no ids."""
    from pyspark.sql import types as T

    sent = df.sparkSession.sparkContext.broadcast(vocabulary(model).table)
    at, schema = df.columns.index(ids_col), T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if x is None else decode_ids(x, sent.value) for x in b.column(at).to_pylist()]
            kept = [c for c, f in zip(b.columns, b.schema.names, strict=True) if f != out]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)
