"""SentencePiece segmentations sampled without replacement: Gumbel top-k by a perturbed A* search.

A text's lattice holds all its segmentations into pieces of a vocabulary file; one
of pieces p1..pn has a probability in proportion to prod p(pi)^alpha.  Pieces never
reach over a unit (white space marks with the letters after them; a line feed), so
the lattice is a chain of unit lattices whose sums are computed once per distinct
unit of a batch.  So is each unit's way of likeliest edges; a unit whose random
numbers all stay on it gets it as a whole, only others are walked edge by edge.

The search holds regions of segmentations, each with the largest of its
segmentations' Gumbel-perturbed log probabilities (exact, from the region's
probability).  The best region is taken; its best segmentation is a draw from the
region and is emitted; the rest of the region is split into "the same up to unit u,
another way through u" for every unit u, whose Gumbels are drawn below the emitted
one.  The k emitted segmentations are distinct and in falling order; the next best
Gumbel is the threshold kappa, and a segmentation of log probability l has the
inclusion probability 1 - exp(-exp(l - kappa)).

All randomness is a hash of seed, row key, sample, unit and step, so results do not
depend on batches, partitions or retries.

A unigram model gives log probabilities itself.  The scores of a BPE model are
merge ranks; pieces then have probabilities by Zipf's law over their ranks.
Pieces of marks alone have their place too, after the others if their score is
-1e9.  Characters without a piece become byte pieces.

What is left of a region is summed over the ways that remain (log-sum-exp), never
taken as a difference from one, so no segmentation is lost however unlikely it
is.  Sums over a unit's ways are taken in plain doubles where bounds on their
logarithms show that they fit (ROOM), else in log space.  Regions behind a prefix of log probability below FAR are not looked at first:
the uniform numbers have 52 bits, so such a region's Gumbel is below FAR + MOST; only if a document's best
region is not above that is it sampled again with all of its regions.

Edge cases: a null or empty text has one segmentation, the empty one; with fewer
than k segmentations all are emitted (kappa is then minus infinity and the
inclusion probability 1); rows are keyed by doc_id, so rows that repeat a doc_id
and text have the same samples; a null doc_id is a key like any other.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import release_memory

K, ALPHA, SEED = 4, 1.0, 42
MARK = "▁"
UNIT = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
CHUNK_UNITS = 200_000  # units sampled in one go
USUAL = 8  # steps of a unit's likeliest way up to which it is looked at as a whole
ROOM = 600.0  # sums whose logarithms surely stay within this are taken as they are, others in log space
FAR = -100.0  # regions of a smaller log probability are looked at only if they can matter (see MOST)
MOST = 37.5  # above its location no Gumbel of `uniform` lies higher: -log(-log(1 - 2^-53)) < 37
_STEP = np.uint64(0x9E3779B97F4A7C15)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit_keys(key: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """A key for each unit of a document."""
    return _mix(key + _STEP * (unit.astype(np.uint64) + np.uint64(1)))


def uniform(key: np.ndarray, sample: int, step: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from the units' keys and two counters."""
    x = _mix(key + np.uint64((sample * 1_000_003 + step + 1) * int(_STEP) & ((1 << 64) - 1)))
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


_MASK = (1 << 64) - 1


def uniform_of(key: int, sample: int, step: int) -> float:
    """`uniform` of one key."""
    x = (key + (sample * 1_000_003 + step + 1) * int(_STEP)) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return (((x ^ (x >> 31)) >> 12) + 0.5) / (1 << 52)


class PieceModel:
    """Pieces, their log probabilities and a table of hashed prefixes."""

    def __init__(self, path: str, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor

        self.processor = sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        marks = {i for i in range(n) if not sp.id_to_piece(i).strip(MARK)}  # runs of marks: they stay inside a unit
        usable = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
                  and (sp.get_score(i) > -1e8 or len(sp.id_to_piece(i)) == 1 or i in marks)
                  and (MARK not in sp.id_to_piece(i)[1:] or i in marks)]
        scores = np.array([sp.get_score(i) for i in usable])
        if len(scores) and (scores == np.round(scores)).all() and scores.min() < -1000:  # ranks
            order = np.empty(len(scores))
            order[np.argsort(-scores, kind="stable")] = np.arange(len(scores))
            scores = -np.log(order + 2.7)
            scores -= np.log(np.exp(scores).sum())
        elif (scores > -1e8).any():  # -1e9 is no log probability
            scores = np.maximum(scores, scores[scores > -1e8].min())
        self.byte_score = alpha * float(scores.min() if len(scores) else 0.0)
        text = {sp.id_to_piece(i): (i, alpha * s) for i, s in zip(usable, scores.tolist(), strict=True)}
        self.single = {t for t in text if len(t) == 1}
        known: dict[str, tuple[int, float]] = {}
        for t, value in text.items():
            for k in range(1, len(t)):
                known.setdefault(t[:k], (-1, 0.0))
            known[t] = value
        self.longest = max(map(len, known), default=0)
        hashes = np.array([self._hash_of(t) for t in known], np.uint64)
        at = np.argsort(hashes)
        self.hashes = hashes[at]
        self.ids = np.array([v[0] for v in known.values()], np.int32)[at]
        self.scores = np.array([v[1] for v in known.values()])[at]
        self.weights = np.exp(self.scores)
        pieces = self.scores[self.ids >= 0]
        self.least = float(pieces.min(initial=0.0))
        top = max(float(pieces.max(initial=-math.inf)), self.byte_score, 4 * self.byte_score)
        self.growth = max(0.0, top + math.log(max(1, self.longest)))  # of a sum's logarithm per letter, at most
        self.slots = np.searchsorted(self.hashes >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64)).astype(np.int32)
        self.fullest = int(np.diff(self.slots).max()) if len(known) else 0
        self.spelt = self._spelt()

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash in the table, -1 for none: the few entries of its slot are compared."""
        slot = (h >> np.uint64(44)).astype(np.int64)
        found = np.full(len(h), -1, np.int32)
        low, high = self.slots[slot], self.slots[slot + 1]
        ask = np.flatnonzero(high > low)
        low, high = low[ask], high[ask]
        for _ in range(self.fullest):
            hit = self.hashes[low] == h[ask]
            found[ask[hit]] = low[hit]
            on = ~hit & (low + 1 < high)
            ask, low, high = ask[on], low[on] + 1, high[on]
            if not len(ask):
                break
        return found

    @staticmethod
    def _hash_of(text: str) -> int:
        h = 0
        for c in text:
            h = ((h + ord(c) + 1) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)
            h ^= h >> 29
        return h

    def normalize(self, text: str) -> str:
        """As the vocabulary's own: white space marks, one before the text."""
        return (MARK + text.replace(" ", MARK)) if text else ""

    def _spelt(self) -> pa.BinaryArray | None:
        """The bytes that each id writes, a space for a mark; None where the vocabulary has no byte pieces for some bytes."""
        if len(self.bytes) < 256:
            return None
        sp, byte = self.processor, {i: bytes([b]) for b, i in self.bytes.items()}
        return pa.array([byte[i] if i in byte else b"" if sp.is_control(i) else sp.id_to_piece(i).replace(MARK, " ").encode()
                         for i in range(sp.get_piece_size())], pa.large_binary())

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, .., size[0] numbers in all, then those from begin[1] on, and so on."""
    ends = np.cumsum(size)
    found = np.repeat(begin - (ends - size), size)
    found += np.arange(len(found))
    return found


class Lattices:
    """The unit lattices of a batch of distinct units, as flat arrays of nodes and edges.

    Nodes with equally many letters left to their unit's end stand together, fewer letters first and longer units
    first within them, so the sums over all ways to the end are taken slice by slice.
    """

    def __init__(self, model: PieceModel, points: np.ndarray, sizes: np.ndarray):
        """`points`: the letters of all units, `sizes` of each (at least one)."""
        units = len(sizes)
        longest = int(sizes.max())
        rank = np.empty(units, np.int32)
        rank[np.argsort(-sizes, kind="stable")] = np.arange(units, dtype=np.int32)
        count = units - np.searchsorted(np.sort(sizes), np.arange(longest + 1))  # units of so many letters or more
        off = np.concatenate(([0], np.cumsum(count))).astype(np.int32)  # the first node with so many letters left
        nodes, self.units = int(off[-1]), units  # nodes below `units` are ends
        self.root = off[sizes] + rank
        left = np.repeat(np.arange(longest + 1, dtype=np.int32), count)  # letters from a node to its unit's end
        letter = np.zeros(nodes, np.uint64)  # that follows a node, plus one
        letter[off[(np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))).astype(np.int32)] + np.repeat(rank, sizes)] = (
            points.astype(np.uint64) + np.uint64(1))
        live = here = np.arange(units, nodes, dtype=np.int32)
        h = np.zeros(len(live), np.uint64)
        out = np.zeros(nodes, np.int32)  # edges of each node so far
        parts = []  # of each length: first node, its edges before, last node, places in the model's table
        covered = np.arange(nodes) < units
        single = np.zeros(nodes)  # the score of each letter alone
        for k in range(min(model.longest, longest)):
            cut = int(np.searchsorted(live, off[k + 1]))  # nodes with more letters left
            live, h, here = live[cut:], h[cut:], here[cut:]
            if not len(live):
                break
            h = (h + letter[here]) * _STEP
            h ^= h >> np.uint64(29)
            at = model.find(h)
            ok = np.flatnonzero(at >= 0)
            live, h, at = live[ok], h[ok], at[ok]
            here = live - (off - off[np.maximum(np.arange(len(off)) - (k + 1), 0)])[left[live]]  # a letter further
            piece = np.flatnonzero(model.ids[at] >= 0)
            first, kind = live[piece], at[piece]
            parts.append((first, out[first], here[piece], kind))
            out[first] += 1  # a node is met once per length
            if k == 0:
                covered[first] = True
                single[first] = model.scores[kind]
        bare = np.flatnonzero(~covered)  # before characters that only byte pieces can write
        self.spelled: list[list[int]] = []
        if len(bare):
            letters, nth = np.unique(letter[bare], return_inverse=True)
            self.spelled = [[model.bytes.get(b, 0) for b in chr(c - 1).encode("utf-8", "surrogatepass")] for c in letters.tolist()]
            single[bare] = np.array([len(s) for s in self.spelled])[nth] * model.byte_score
            parts.append((bare.astype(np.int32), out[bare], (bare - off[left[bare]] + off[left[bare] - 1]).astype(np.int32), -1 - nth))
            out[bare] += 1
        self.low = np.concatenate((np.zeros(1, np.int32), np.cumsum(out, dtype=np.int32)))
        edges = int(self.low[-1])
        self.target, self.ids = np.empty(edges, np.int32), np.empty(edges, np.int32)
        self.p, score = np.empty(edges), np.empty(edges)
        # every node has an edge of one letter, so the sum of its ways is at least the product of its letters alone
        alone = np.bincount(np.arange(nodes) - off[left], single, units)[rank]
        far = (alone + min(0.0, model.least) < -ROOM) | (sizes * model.growth > ROOM) | (alone > ROOM)
        for first, nth, target, kind in parts:
            at = self.low[first] + nth  # the edges of a node stand together
            self.target[at] = target
            if len(kind) and kind[0] < 0:  # a spelled character
                self.ids[at], score[at], self.p[at] = kind, single[first], np.exp(single[first])
                continue
            self.ids[at], self.p[at] = model.ids[kind], model.weights[kind]
            if far.any():
                score[at] = model.scores[kind]
        total = np.ones(nodes)  # the sum over all ways to the unit's end
        with np.errstate(all="ignore"):  # what comes out for the units of `far` is not used
            for left in range(1, int(sizes[~far].max(initial=0)) + 1):
                a, z = off[left], off[left + 1]
                low, high = self.low[a], self.low[z]
                self.p[low:high] *= total[self.target[low:high]]
                total[a:z] = np.add.reduceat(self.p[low:high], self.low[a:z] - low)
            self.p /= np.repeat(total, out)
            self.logp = np.log(self.p)
        if far.any():
            self._in_logs(score, off, rank[far], sizes[far])
        self.best = np.full(nodes, -1, np.int32)  # edges are far fewer than 2^31
        self._usual_ways()

    def _in_logs(self, score: np.ndarray, off: np.ndarray, rank: np.ndarray, sizes: np.ndarray) -> None:
        """The probabilities of the edges of some units, summed in log space."""
        beta = np.zeros(len(self.low) - 1)
        for left in range(1, int(sizes.max()) + 1):
            node = off[left] + rank[sizes >= left]
            low, size = self.low[node], self.low[node + 1] - self.low[node]
            edges = _ranges(low, size)
            value = score[edges] + beta[self.target[edges]]
            beta[node] = np.logaddexp.reduceat(value, np.cumsum(size) - size)
            self.logp[edges] = value - np.repeat(beta[node], size)
            self.p[edges] = np.exp(self.logp[edges])

    def _edges(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The probabilities of all edges of some nodes, where each node's begin, and how many they are."""
        low = self.low[node]
        size = self.low[node + 1] - low
        return self.p[_ranges(low, size)], np.cumsum(size) - size, size

    def _likeliest(self, node: np.ndarray) -> np.ndarray:
        """Each node's likeliest edge (the first, if several are), found when a node is first met."""
        best = self.best[node]
        new = np.flatnonzero(best < 0)
        if len(new):
            fresh = node[new]
            p, heads, size = self._edges(fresh)
            likely = np.flatnonzero(p == np.repeat(np.maximum.reduceat(p, heads), size))
            if len(likely) > len(heads):
                likely = likely[np.searchsorted(likely, heads)]
            best[new] = self.best[fresh] = self.low[fresh] + (likely - heads)
        return best

    def _usual_ways(self) -> None:
        """Of each unit the way of likeliest edges: its edges, their number, its log probability and that of all other ways."""
        live, node = np.arange(self.units), self.root
        self.usual_logp, self.usual_size = np.zeros(self.units), np.zeros(self.units, np.int64)
        seen, edges, nodes, self.usual_p = [], [], [], []
        for step in range(USUAL):
            e = self._likeliest(node)
            self.usual_logp[live] += self.logp[e]
            p = np.empty(self.units)
            p[live] = self.p[e]
            self.usual_p.append(p)  # of each step
            seen.append(live)
            edges.append(e)
            nodes.append(node)
            node = self.target[e]
            done = node < self.units
            self.usual_size[live[done]] = step + 1
            live, node = live[~done], node[~done]
            if not len(live):
                break
        # longer ones are walked step by step: size zero
        self.usual_first = np.cumsum(self.usual_size) - self.usual_size
        self.usual_edges = np.empty(int(self.usual_size.sum()), np.int32)
        source = np.empty(len(self.usual_edges), np.int32)
        for step, (unit, e, n) in enumerate(zip(seen, edges, nodes, strict=True)):
            short = np.flatnonzero(self.usual_size[unit])
            at = self.usual_first[unit[short]] + step
            self.usual_edges[at], source[at] = e[short], n[short]
        self.usual_other = np.full(self.units, -np.inf)
        short = np.flatnonzero(self.usual_size)
        if len(short):
            self.usual_other[short] = self.others(self.usual_edges, source, self.usual_first[short])

    def others(self, edges: np.ndarray, source: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Of each way (a run of edges, beginning at `heads`) the log probability of all others of its unit: the sum over
        the places where they leave it."""
        logp, p = self.logp[edges], self.p[edges]
        before = np.cumsum(logp) - logp
        before -= np.repeat(before[heads], np.diff(heads, append=len(edges)))
        # the share of a node's other edges, summed without taking differences of nearly equal numbers
        small, runs, _ = self._edges(source)
        best = self.best[source]
        at = runs + (best - self.low[source])
        top = small[at]
        small[at] = 0.0
        rest = np.add.reduceat(small, runs)
        rest = np.where(edges == best, rest, np.maximum(rest - p, 0.0) + top)
        with np.errstate(divide="ignore"):
            return np.logaddexp.reduceat(before + np.log(rest), heads)

    def draw(self, node: np.ndarray, r: np.ndarray) -> np.ndarray:
        """An edge of each node, by its probability: mostly the likeliest, else one of the others by their running sums."""
        edge = self._likeliest(node)
        rare = np.flatnonzero(r >= self.p[edge])
        if len(rare):
            best, low = edge[rare], self.low[node[rare]]
            p, runs, size = self._edges(node[rare])
            at, mine = runs + (best - low), self.p[best]
            p[at] = 0.0
            other = np.add.reduceat(p, runs)
            cum = np.cumsum(p)
            cum -= np.repeat(cum[runs] - p[runs], size)  # within the node, its likeliest edge left out
            t = (r[rare] - mine) / np.maximum(1 - mine, 1e-300) * other
            passed = cum <= np.repeat(t, size)
            passed[at] = False
            nth = np.add.reduceat(passed, runs, dtype=np.int64)
            nth = np.minimum(nth, np.maximum(size - 2, 0))
            nth += nth >= best - low  # as if the likeliest were not there
            edge[rare] = np.where(size == 1, best, low + nth)
        return edge


class _Left:
    """The ways through a unit that are not taken, as a tree of the taken ones: of each edge on them the log probability
    of the ways left through it, of each node that of all.  Summed over those ways, so that it is right however little
    is left, and minus infinity only if nothing is."""

    def __init__(self, lat: Lattices, root: int):
        self.lat = lat
        self.after: list[dict[int, int]] = []  # of each place of the tree its edges that are taken, and where they lead
        self.low: list[int] = []
        self.logs: list[list[float]] = []
        self.total: list[float] = []
        self.root = root
        self._open(root)

    def _open(self, node: int) -> int:
        low = int(self.lat.low[node])
        self.after.append({})
        self.low.append(low)
        self.logs.append(self.lat.logp[low:int(self.lat.low[node + 1])].tolist())
        self.total.append(0.0 if node >= self.lat.units else -math.inf)
        return len(self.low) - 1

    def take(self, way: list[int]) -> None:
        """Take one more way (a list of edges)."""
        at, places = 0, []
        for e in way:
            places.append(at)
            on = self.after[at].get(e)
            if on is None:
                on = self.after[at][e] = self._open(int(self.lat.target[e]))
            at = on
        for at, e in zip(reversed(places), reversed(way), strict=True):
            logs = self.logs[at]
            logs[e - self.low[at]] = float(self.lat.logp[e]) + self.total[self.after[at][e]]
            top = max(logs)
            self.total[at] = top + math.log(sum([math.exp(x - top) for x in logs])) if top > -math.inf else -math.inf

    def draw(self, key: int, sample: int) -> list[int]:
        """One of the ways that are left."""
        lat, way, node, at = self.lat, [], self.root, 0
        while node >= lat.units:
            if at is None:  # off the tree: all ways are left
                low = int(lat.low[node])
                logs = lat.logp[low:int(lat.low[node + 1])].tolist()
            else:
                low, logs = self.low[at], self.logs[at]
            top = max(logs)
            shares = [math.exp(x - top) for x in logs]
            r = uniform_of(key, sample, 1 << 10 | len(way)) * sum(shares)
            pick = logs.index(top)
            for k, share in enumerate(shares):
                if r < share:
                    pick = k
                    break
                r -= share
            pick += low
            way.append(pick)
            at, node = None if at is None else self.after[at].get(pick), int(lat.target[pick])
        return way


class _Numbered(dict):
    """Numbers its keys as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all (normalized) texts, where their units begin, and how many each text has."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    mark, line = points == ord(MARK), points == ord("\n")
    begins = line.copy()  # as UNIT has it
    begins[1:] |= line[:-1] | (mark[1:] & ~mark[:-1])
    heads = np.cumsum(sizes) - sizes
    begins[heads[sizes > 0]] = True
    first = np.flatnonzero(begins)
    return points, first, np.diff(np.searchsorted(first, np.append(heads, len(points))))


def _numbered(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each unit's kind, and of each kind the first unit; kinds by hash, each letter compared after."""
    sizes = np.diff(first, append=len(points))
    pos = np.arange(len(points)) - np.repeat(first, sizes)
    power = np.cumprod(np.full(int(sizes.max()), _STEP))
    codes, _ = pd.factorize(np.add.reduceat((points + np.uint64(1)) * power[pos], first))
    some = np.empty(int(codes.max()) + 1, np.int64)
    some[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    like = some[codes]
    if (sizes != sizes[like]).any() or (points != points[np.repeat(first[like], sizes) + pos]).any():
        kinds = _Numbered()  # two kinds have one hash
        codes = np.array([kinds[points[a:a + n].tobytes()] for a, n in zip(first.tolist(), sizes.tolist(), strict=True)])
        some = np.unique(codes, return_index=True)[1]
    return codes, some


class _Batch:
    """The units of some texts, and the paths drawn through them."""

    def __init__(self, model: PieceModel, keys: np.ndarray, texts: list[str]):
        points, first, self.sizes = _units(texts)
        self.kind, some = _numbered(points, first)
        sizes = np.diff(first, append=len(points))[some]
        self.lat = Lattices(model, points[_ranges(first[some], sizes)], sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.pos = np.arange(len(self.kind)) - self.starts[self.doc]
        self.keys = keys
        self.key = unit_keys(keys[self.doc], self.pos)

    def walk(self, units: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Draw a way through each of `units`: the number of its edges, all edges in order of unit and step, its log
        probability, and whether it is the usual way."""
        lat, kind, key = self.lat, self.kind[units], self.key[units]
        pieces = lat.usual_size[kind]
        usual = pieces > 0
        live = np.flatnonzero(usual)
        for step, p in enumerate(lat.usual_p):
            off = uniform(key[live], sample, step) >= p[kind[live]]
            usual[live[off]] = False
            live = live[~off]
            live = live[pieces[live] > step + 1]
            if not len(live):
                break
        logq = lat.usual_logp[kind]
        rare = np.flatnonzero(~usual)
        pieces[rare], rare_edges, logq[rare] = self._steps(units[rare], sample)
        edges = np.empty(int(pieces.sum()), np.int64)
        known, of = np.repeat(usual, pieces), np.flatnonzero(usual)
        edges[known] = lat.usual_edges[_ranges(lat.usual_first[kind[of]], pieces[of])]
        edges[~known] = rare_edges
        return pieces, edges, logq, usual

    def _steps(self, units: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`walk` edge by edge: number of edges, edges, log probability."""
        lat, live, step = self.lat, np.arange(len(units)), 0
        node, key = lat.root[self.kind[units]], self.key[units]
        logq, pieces = np.zeros(len(units)), np.zeros(len(units), np.int64)
        seen, edges = [], []
        while len(live):
            e = lat.draw(node, uniform(key[live], sample, step))
            logq[live] += lat.logp[e]
            seen.append(live)
            edges.append(e)
            node = lat.target[e]
            step += 1
            done = node < lat.units
            pieces[live[done]] = step
            live, node = live[~done], node[~done]
        place = np.cumsum(pieces) - pieces
        found = np.empty(int(pieces.sum()), np.int64)
        for k, (at, e) in enumerate(zip(seen, edges, strict=True)):
            found[place[at] + k] = e
        return pieces, found, logq

    def others(self, units: np.ndarray, pieces: np.ndarray, edges: np.ndarray, usual: np.ndarray) -> np.ndarray:
        """The log probability of all ways through each of `units` but its own (`pieces` and `usual`: of every unit)."""
        lat, found = self.lat, self.lat.usual_other[self.kind[units]]
        rare = np.flatnonzero(~usual[units])
        if len(rare):
            wanted = np.zeros(len(self.doc), bool)
            wanted[units[rare]] = True
            mine, size = edges[np.repeat(wanted, pieces)], pieces[units[rare]]
            heads = np.cumsum(size) - size
            source = np.empty(len(mine), np.int64)  # an edge begins where the one before it ends
            source[1:] = lat.target[mine[:-1]]
            source[heads] = lat.root[self.kind[units[rare]]]
            found[rare] = lat.others(mine, source, heads)
        return found


def _starts(size: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs begins, and the end of the last."""
    return np.concatenate(([0], np.cumsum(size)))


def _below(log_mass: np.ndarray, bound: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Gumbels of these locations below a bound (plus infinity: none)."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        g = log_mass - np.log(-np.log(r) + np.exp(log_mass - bound))
    return np.where(np.isneginf(log_mass), -np.inf, np.minimum(g, bound))


def sample_batch(model: PieceModel, keys: np.ndarray, texts: list[str], k: int = K, far: float = FAR,
                 decode: bool = False) -> list[list]:
    """Per text up to k tuples (ids, log probability, perturbed log probability, decoded text), and last the threshold kappa."""
    some = [d for d, t in enumerate(texts) if t]
    found: list[list] = [[] if t else [(b"", 0.0, 0.0, "")] for t in texts]
    kappa = [-math.inf] * len(texts)
    if some:
        _sample_texts(model, keys[some], [model.normalize(texts[d]) for d in some], k, found, kappa, some, far, decode)
    return [[*f, kappa[d]] for d, f in enumerate(found)]


def _decoded(model: PieceModel, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
    """The texts of consecutive runs of ids; the space that stands for a text's first mark is dropped, as the vocabulary does."""
    if model.spelt is None:
        return [model.decode(ids[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    written = model.spelt.take(pa.array(ids))
    ends = np.frombuffer(written.buffers()[1], np.int64)[cuts].tolist()
    raw = memoryview(written.buffers()[2] or b"")
    return [str(raw[a:b], "utf-8", "replace").removeprefix(" ") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _sample_texts(model: PieceModel, keys: np.ndarray, texts: list[str], k: int, found: list, kappa: list,
                  names: list[int], far: float, decode: bool) -> None:
    b = _Batch(model, keys, texts)
    lat, docs, all_units = b.lat, len(texts), np.arange(len(b.doc))
    zero = np.zeros(docs, np.int64)
    best = -np.log(-np.log(uniform(unit_keys(keys, zero), 0, 1 << 20)))  # the root's Gumbel: its probability is one
    pieces, edges, logq, usual = b.walk(all_units, 1)
    paths = [(pieces, edges, logq, _starts(pieces))]  # of each sample: every document's path (empty where it has no more)
    gumbels, taken = [], {}  # of each sample: the Gumbel of "another way through unit u"; ways excluded there
    skipped = np.zeros(docs, bool)  # documents with regions below `far`

    def regions(logq: np.ndarray, way: tuple, top: np.ndarray, after: np.ndarray, sample: int) -> np.ndarray:
        """Gumbels of the regions that leave a path at each unit behind `after` (per document)."""
        run = np.cumsum(logq)
        before = run - logq
        before -= np.repeat(before[b.starts], b.sizes)  # of the units before, in the same document
        behind = b.pos > np.repeat(after, b.sizes)
        near = before > far
        some = np.flatnonzero(near & behind)
        skipped[b.doc[np.flatnonzero(~near & behind)]] = True
        g = np.full(len(logq), -np.inf)
        if len(some):
            g[some] = _below(before[some] + b.others(some, *way), top[b.doc[some]], uniform(b.key[some], sample, 1 << 21))
        return g

    def emit(sample: int, which: np.ndarray, g: np.ndarray) -> None:
        _, edges, logq, start = paths[sample]
        total = np.bincount(b.doc, weights=logq, minlength=docs)
        ids = lat.ids[edges]
        cuts = start[np.append(b.starts, len(b.doc))]
        spelled = np.flatnonzero(ids < 0)
        if len(spelled):  # characters written as several byte pieces
            lists = [lat.spelled[k] for k in (-1 - ids[spelled]).tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[spelled] = [len(x) for x in lists]
            start = _starts(counts)
            cuts, ids = start[cuts], np.repeat(ids, counts)
            ids[_ranges(start[spelled], counts[spelled])] = [x for s in lists for x in s]
        texts = _decoded(model, ids, cuts) if decode else [None] * docs
        raw, low, total, g = ids.astype("<u4").tobytes(), (4 * cuts).tolist(), total.tolist(), g.tolist()
        for d in which.tolist():
            found[names[d]].append((raw[low[d]:low[d + 1]], total[d], g[d], texts[d]))

    everyone = np.arange(docs)
    emit(0, everyone, best)
    gumbels.append(regions(logq, (pieces, edges, usual), best, np.full(docs, -1), 1))
    alive, unsure = np.ones(docs, bool), np.zeros(docs, bool)
    for sample in range(2, k + 2):
        tops = np.array([np.maximum.reduceat(g, b.starts) for g in gumbels])
        source, best = tops.argmax(axis=0), tops.max(axis=0)
        unsure |= alive & skipped & (best <= far + MOST)  # a region that was not looked at might be the best
        alive &= ~np.isneginf(best)
        for d, g in enumerate(np.where(alive, best, -math.inf).tolist()):
            kappa[names[d]] = g
        if sample > k or not alive.any():
            break
        # the popped region: the path of sample `source` up to unit `left`, another way there, all else drawn anew
        left = np.zeros(docs, np.int64)
        of = np.repeat(np.where(alive, source, -1), b.sizes)
        top = np.repeat(best, b.sizes)
        for s, g in enumerate(gumbels):
            hit = np.flatnonzero((of == s) & (g == top))[::-1]
            left[b.doc[hit]] = b.pos[hit]  # the first of a document comes last
        part = of >= 0
        where = b.pos - np.repeat(left, b.sizes)
        fresh = np.flatnonzero(part & (where > 0))
        pieces, logq, usual = np.zeros(len(b.doc), np.int64), np.zeros(len(b.doc)), np.zeros(len(b.doc), bool)
        pieces[fresh], fresh_edges, logq[fresh], usual[fresh] = b.walk(fresh, sample)
        drawn = (pieces.copy(), fresh_edges, usual)
        fresh_start = _starts(pieces)
        popped, masses = [], []
        new: dict[int, list[int]] = {}
        head: dict[int, np.ndarray] = {}  # of each unit where a path is left the edges before
        for s, (p_pieces, p_edges, p_logq, p_start) in enumerate(paths):
            which = np.flatnonzero(alive & (source == s))
            if not len(which):
                continue
            copy = (of == s) & (where < 0)
            pieces[copy], logq[copy] = p_pieces[copy], p_logq[copy]
            at_unit = b.starts[which] + left[which]
            low, high, kind = p_start[at_unit], p_start[at_unit + 1], b.kind[at_unit]
            for u, a, z in zip(at_unit.tolist(), p_start[b.starts[which]].tolist(), low.tolist(), strict=True):
                head[u] = p_edges[a:z]
            for u, a, z, root, key in zip(at_unit.tolist(), low.tolist(), high.tolist(), lat.root[kind].tolist(),
                                          b.key[at_unit].tolist(), strict=True):
                ways = taken.get((s, u))
                if ways is None:
                    ways = taken[s, u] = _Left(lat, root)
                    ways.take(p_edges[a:z].tolist())
                new[u] = ways.draw(key, sample)
                ways.take(new[u])
                popped.append((s, u))
                masses.append(ways.total[0])
        units = sorted(new)
        size = np.array([len(new[u]) for u in units])
        new_edges = np.fromiter(chain.from_iterable(new[u] for u in units), np.int64, int(size.sum()))
        pieces[units], logq[units] = size, np.bincount(np.repeat(np.arange(len(units)), size), lat.logp[new_edges], len(units))
        s_of, u_of = np.array(popped, np.int64).T
        run = np.cumsum(logq)
        before = (run - logq)[u_of] - (run - logq)[b.starts[b.doc[u_of]]]
        again = _below(before + np.array(masses), best[b.doc[u_of]], uniform(b.key[u_of], sample, 1 << 22))
        cut, last = _starts(size).tolist(), (b.starts + b.sizes)[b.doc[units]]
        edges = np.concatenate([some for u, a, z, low, high in zip(units, cut[:-1], cut[1:], fresh_start[units].tolist(),
                                                                   fresh_start[last].tolist(), strict=True)
                                for some in (head[u], new_edges[a:z], fresh_edges[low:high])])
        paths.append((pieces, edges, logq, _starts(pieces)))
        emit(sample - 1, np.flatnonzero(alive), best)
        gumbels.append(np.where(part, regions(logq, drawn, best, np.where(alive, left, len(b.doc)), sample), -np.inf))
        for s, u, g in zip(s_of.tolist(), u_of.tolist(), again.tolist(), strict=True):
            gumbels[s][u] = g
    redo = np.flatnonzero(unsure).tolist()
    if redo:  # once more with every region
        for d in redo:
            found[names[d]] = []
        _sample_texts(model, keys[redo], [texts[d] for d in redo], k, found, kappa, [names[d] for d in redo], -math.inf, decode)


_models: dict[tuple[str, float], PieceModel] = {}


def sample_segmentations(docs: DataFrame, vocabulary: str | None = None, k: int = K, alpha: float = ALPHA,
                         seed: int = SEED, decode: bool = False) -> DataFrame:
    """Up to k rows per row of `docs` (doc_id, text): the sampled ids (little-endian unsigned 32-bit) and scores.

    With `decode`, also `decoded`: the text of the ids, by the vocabulary's own decoder.
    """
    path = vocabulary or default_vocabulary()
    schema = ("doc_id long, sample int, n_ids long, ids_crc32 long, log_prob double, perturbed double, "
              "inclusion double, ids binary" + (", decoded string" if decode else ""))
    names = [f.split()[0] for f in schema.split(", ")]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary(),
             *[pa.string()] * decode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, alpha) not in _models:
            _models[path, alpha] = PieceModel(path, alpha)
        model = _models[path, alpha]

        def out(ids: list, keys: list, texts: list) -> pa.RecordBatch:
            rows = []
            sampled = sample_batch(model, np.array(keys, np.int64).view(np.uint64), texts, k, decode=decode)
            for doc_id, (*samples, kappa) in zip(ids, sampled, strict=True):
                for n, (raw, logp, g, text) in enumerate(samples):
                    share = -math.expm1(-math.exp(min(700.0, logp - kappa))) if kappa > -math.inf else 1.0
                    rows.append((doc_id, n, len(raw) // 4, zlib.crc32(raw), logp, g, share, raw, *[text] * decode))
            cols = list(zip(*rows, strict=True)) or [[]] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        ids, keys, texts, used = [], [], [], 0
        for b in batches:
            for doc_id, key, text in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(), b.column("text"),
                                         strict=True):
                text = text.as_py() or ""
                ids.append(doc_id)
                keys.append(key)
                texts.append(text)
                used += len(text)
                if used >= 6 * CHUNK_UNITS:
                    yield out(ids, keys, texts)
                    ids, keys, texts, used = [], [], [], 0
        if texts:
            yield out(ids, keys, texts)
        release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")
                       ).alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """`rows` with `decoded`: the text of the column `ids`."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, ALPHA) not in _models:
            _models[path, ALPHA] = PieceModel(path, ALPHA)
        model = _models[path, ALPHA]
        for b in batches:
            texts = [model.decode(np.frombuffer(x.as_py() or b"", "<u4").tolist()) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    return rows.mapInArrow(run, rows.withColumn("decoded", F.lit("")).schema)


def op4_sampling(docs: DataFrame) -> DataFrame:
    """K sampled segmentations of every document: their ids and scores, and the text decoded from the ids."""
    return sample_segmentations(docs.select("doc_id", "text"), decode=True)
