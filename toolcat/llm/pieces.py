"""SentencePiece encoding, decoding, and sampling of distinct segmentations by Gumbel top-k.

The pieces of a text form a lattice. A segmentation's weight is the product of its pieces' weights,
``exp(score / temperature - penalty)``, and its probability that weight's share of the lattice. Perturbed A-star
search draws k segmentations without replacement: a node stands for all segmentations with one prefix, carries their
probability and a Gumbel perturbed by it, and the node with the largest is opened; its best path is the next sample
and the prefixes that branch off from it, whose Gumbels are drawn below its own, are the new nodes. The perturbed
log-probability of the (k+1)-th gives each sample its inclusion score. Draws are seeded by the row key.

No piece crosses a word's end, so the lattice falls into words. The arcs of distinct words and their conditional
probabilities are computed for many words at once and kept in two generations of flat arrays; paths of many texts
are drawn together. Characters without a piece are spelled in bytes.

Null texts count as empty; they have one segmentation, without pieces. A text with fewer than k segmentations gives
all it has. Null ``doc_id`` counts as the key 'None'. Repeated rows give the same samples. The character U+2581
decodes to a space. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain
from math import exp, expm1, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolcat.llm.common import text_or_empty
from toolcat.llm.tokens import tokenizer_path

SPACE = "▁"
TEMPERATURE, PENALTY = 4000.0, 3.0
#: Lattice nodes that are kept at once in each generation; words of more than WORD characters are not kept.
NODES, WORD = 1_500_000, 48
#: Characters of texts that are sampled together.
CHARS = 200_000
_SPLIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def uniform(keys: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """The n-th number between 0 and 1 of each key's stream."""
    x = keys + (np.atleast_1d(n).astype(np.uint64) + np.uint64(1)) * _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _subkeys(keys: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """A key of its own for the n-th part of each key."""
    x = (keys ^ (np.atleast_1d(n).astype(np.uint64) * _M2)) * _M1
    return x ^ (x >> np.uint64(29))


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of several ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Pieces:
    """The normal pieces in a trie, as an open hash table from (node, character) to node."""

    def __init__(self, texts: list[str], numbers: list[int]):
        self.known = np.zeros(0x110000, dtype=np.int32)  # the number of a character, from 1 on
        chars = sorted({c for t in texts for c in t})
        self.known[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        place, nodes, edges, ends = {c: i + 1 for i, c in enumerate(chars)}, {}, [], [-1]
        for text, number in zip(texts, numbers, strict=True):
            node = 0
            for c in text:
                key = node * self.width + place[c]
                if key not in nodes:
                    nodes[key] = len(ends)
                    ends.append(-1)
                    edges.append(key)
                node = nodes[key]
            ends[node] = number
        self.ends = np.array(ends, dtype=np.int32)
        self.depth = max(map(len, texts), default=0)
        bits = max(4, (4 * len(edges)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 1, -1, dtype=np.int64)
        self.nodes = np.zeros((1 << bits) + 1, dtype=np.int32)
        for key, slot in zip(edges, self._slots(np.array(edges, dtype=np.int64)).tolist(), strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & ((1 << bits) - 1)
            self.keys[slot], self.nodes[slot] = key, nodes[key]
        self.mask = (1 << bits) - 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _GOLDEN) >> self.shift).astype(np.int64)

    def _step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The next nodes, 0 where there is none."""
        keys = nodes.astype(np.int64) * self.width + chars
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.nodes[slots], 0)
        go = np.flatnonzero((held != keys) & (held >= 0))
        while len(go):
            slots[go] = (slots[go] + 1) & self.mask
            held = self.keys[slots[go]]
            hit = held == keys[go]
            out[go[hit]] = self.nodes[slots[go[hit]]]
            go = go[~hit & (held >= 0)]
        out[chars == 0] = 0
        return out

    def matches(self, codes: np.ndarray, left: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length from 1 on: where pieces of that length begin, and their numbers. ``left``: characters from each
        place to its word's end."""
        chars, out = self.known[codes], []
        at = np.arange(len(codes))
        nodes = np.zeros(len(codes), dtype=np.int32)
        for d in range(self.depth):
            if d:
                keep = left[at] > d
                at, nodes = at[keep], nodes[keep]
            nodes = self._step(nodes, chars[at + d])
            alive = nodes > 0
            at, nodes = at[alive], nodes[alive]
            ends = self.ends[nodes]
            hit = ends >= 0
            out.append((at[hit], ends[hit]))
            if not len(at):
                break
        return out


class Store:
    """Words' lattices in flat arrays: ``first`` gives each node's first arc; an arc has its piece, the distance to
    its next node (0: the word's end), its log-probability, and the sum of probabilities up to it at its node."""

    def __init__(self) -> None:
        self.starts: dict[str, int] = {}
        self.nodes = self.arcs = 0
        self.first = np.zeros(1, dtype=np.int32)
        self.emit, self.to = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.upto, self.log_p = np.zeros(0, dtype=np.float32), np.zeros(0)

    def add(self, words: list[str], sizes: np.ndarray, counts: np.ndarray, **arrays: np.ndarray) -> None:
        """sizes: nodes of each word; counts: arcs of each node; arrays: by arc."""
        begins = self.nodes + np.cumsum(sizes) - sizes
        self.starts.update(zip(words, begins.tolist(), strict=True))
        self.first = _grown(self.first, self.nodes + 1, self.arcs + np.cumsum(counts))
        for name, new in arrays.items():
            setattr(self, name, _grown(getattr(self, name), self.arcs, new))
        self.nodes += len(counts)
        self.arcs += int(counts.sum())

    def take(self, words: list[str], sizes: np.ndarray, other: Store) -> None:
        """Copy words of another store."""
        nodes = _ranges(np.array([other.starts[w] for w in words], dtype=np.int64), sizes)
        counts = np.diff(other.first)[nodes] if len(nodes) * 4 > other.nodes else other.first[nodes + 1] - other.first[nodes]
        arcs = _ranges(other.first[nodes].astype(np.int64), counts)
        self.add(words, sizes, counts, emit=other.emit[arcs], to=other.to[arcs], upto=other.upto[arcs], log_p=other.log_p[arcs])


class Lattice:
    """The lattices of words, and paths drawn from them."""

    def __init__(self, path: str, temperature: float = TEMPERATURE, penalty: float = PENALTY, nodes: int = NODES):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.limit, self.penalty = nodes, penalty
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.vocabulary = n
        self.log_w = np.zeros(n)
        # What each number of ``emit`` stands for: a piece, or from ``vocabulary`` on the bytes of a character.
        self.spelled: dict[int, int] = {}
        self.spelled_ids: list[list[int]] = []
        shown = [b""] * n  # the bytes that a piece decodes to
        normal = []
        for i in range(n):
            if sp.is_byte(i):
                shown[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append(i)
                self.log_w[i] = max(-float(n), sp.get_score(i)) / temperature - penalty
                shown[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        self.pieces = Pieces([sp.id_to_piece(i) for i in normal], normal)
        self.shown = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.shown_size = np.array([len(b) for b in shown], dtype=np.int64)
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        self.store, self.old = Store(), Store()

    def _spell(self, codes: np.ndarray) -> np.ndarray:
        """The numbers under which the bytes of characters are emitted together."""
        distinct, at = np.unique(codes, return_inverse=True)
        for c in distinct.tolist():
            if c not in self.spelled:
                self.spelled[c] = self.vocabulary + len(self.spelled_ids)
                self.spelled_ids.append([self.bytes[b] for b in chr(c).encode()])
                self.log_w = np.append(self.log_w, -self.penalty * len(self.spelled_ids[-1]))
        return np.array([self.spelled[c] for c in distinct.tolist()], dtype=np.int32)[at]

    def learn(self, words: list[str]) -> None:
        """Put the arcs of new words, here without the space before them, into the store."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        codes = np.frombuffer((SPACE + SPACE.join(words)).encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(codes))
        found = self.pieces.matches(codes, left)
        single = np.zeros(len(codes), dtype=bool)
        if found:
            single[found[0][0]] = True
        odd = np.flatnonzero(~single)
        layers = [(at, number, n + 1) for n, (at, number) in enumerate(found) if len(at)]
        if len(odd):
            layers.append((odd, self._spell(codes[odd]), 1))
        counts = np.zeros(len(codes), dtype=np.int64)
        for at, _, _ in layers:
            counts[at] += 1
        first = np.cumsum(counts) - counts
        total = int(counts.sum())
        emit, length = np.zeros(total, dtype=np.int32), np.zeros(total, dtype=np.int32)
        filled = first.copy()
        for at, number, n in layers:
            emit[filled[at]], length[filled[at]] = number, n
            filled[at] += 1
        # Sums backwards over all words at once, by the characters that are left.
        log_w, beta = self.log_w[emit], np.zeros(len(codes) + 1)
        log_p, upto = np.zeros(total), np.zeros(total, dtype=np.float32)
        order = np.argsort(left.astype(np.int32), kind="stable")
        steps = np.bincount(left, minlength=2)[1:]
        begin = 0
        for n in steps.tolist():
            at = order[begin : begin + n]
            begin += n
            size = counts[at]
            arcs, start = _ranges(first[at], size), np.cumsum(size) - size
            goal = np.repeat(at, size) + length[arcs]
            x = log_w[arcs] + np.where(length[arcs] == np.repeat(left[at], size), 0.0, beta[goal])
            top = np.maximum.reduceat(x, start)
            e = np.exp(x - np.repeat(top, size))
            mass = np.add.reduceat(e, start)
            beta[at] = top + np.log(mass)
            log_p[arcs] = x - np.repeat(beta[at], size)
            running = np.cumsum(e / np.repeat(mass, size))
            running -= np.repeat(running[start] - e[start] / mass, size)
            running[start + size - 1] = 2.0
            upto[arcs] = running
        last = length == np.repeat(left, counts)
        self.store.add(words, sizes, counts, emit=emit, to=np.where(last, 0, length), upto=upto, log_p=np.minimum(log_p, 0.0))

    def words(self, texts: list[str]) -> list[np.ndarray]:
        """The first nodes of the words of each text. Every word begins with a space, which its name here leaves out."""
        found = [
            [] if not t else [w[1:] for w in _SPLIT.findall(SPACE + t.replace(" ", SPACE))]
            if "  " in t or t[0] == " " or SPACE in t else t.split(" ")
            for t in texts
        ]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = list(chain.from_iterable(found))
        if self.store.nodes > self.limit:
            self.old, self.store = self.store, Store()
        starts = self.store.starts
        nodes = list(map(starts.get, flat))
        if None in nodes:
            new = {w for w, x in zip(flat, nodes, strict=True) if x is None}
            if kept := [w for w in new if w in self.old.starts]:
                self.store.take(kept, np.fromiter(map(len, kept), dtype=np.int64, count=len(kept)) + 1, self.old)
                new.difference_update(kept)
            if new:
                self.learn(list(new))
            nodes = [starts[w] if x is None else x for w, x in zip(flat, nodes, strict=True)]
            for w in new:
                if len(w) > WORD:  # its arcs stay until the generation ends, its name goes
                    del starts[w]
        return np.split(np.array(nodes, dtype=np.int64), np.cumsum(sizes)[:-1]) if found else []

    def draw(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path from each of the nodes to its word's end: all arcs, and the number of them for each node."""
        first, upto, to = self.store.first, self.store.upto, self.store.to
        arcs, places = [], []
        counts = np.zeros(len(nodes), dtype=np.int64)
        place, at, step = np.arange(len(nodes)), nodes, 0
        while len(at):
            u = uniform(keys[place], step).astype(np.float32)
            arc = first[at].astype(np.int64)
            go = np.flatnonzero(u >= upto[arc])
            while len(go):
                arc[go] += 1
                go = go[u[go] >= upto[arc[go]]]
            arcs.append(arc)
            places.append(place)
            counts[place] += 1
            jump = to[arc]
            on = jump > 0
            at, place, step = (at + jump)[on], place[on], step + 1
        out, begin = np.zeros(int(counts.sum()), dtype=np.int64), np.cumsum(counts) - counts
        for step, (arc, place) in enumerate(zip(arcs, places, strict=True)):
            out[begin[place] + step] = arc
        return out, counts

    def sample(self, words: list[np.ndarray], k: int, seeds: np.ndarray) -> list[list[tuple[np.ndarray, float, float]]]:
        """For each text up to k distinct paths with their log-probabilities and log inclusion scores."""
        store = self.store
        paths: list[list[dict]] = [[] for _ in words]

        def extend(texts: list[int], prefixes: list[np.ndarray], rest: list[np.ndarray], opened: list[tuple], turn: int) -> None:
            """Complete a path for each of the texts; opened: value, used arcs and what they weigh, whether all are used."""
            sizes = np.array([len(r) for r in rest], dtype=np.int64)
            own = _subkeys(seeds[texts], turn)
            inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            tails, counts = self.draw(np.concatenate(rest), _subkeys(np.repeat(own, sizes), inner + 1))
            upto = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
            parts = [x for p, a, b in zip(prefixes, upto, upto[1:], strict=False) for x in (p, tails[a:b])]
            arcs = np.concatenate(parts)
            sizes = np.array([len(p) for p in prefixes], dtype=np.int64) + np.diff(upto)
            ends = np.cumsum(sizes)
            begins = ends - sizes
            log_p = store.log_p[arcs]
            total = np.cumsum(log_p)
            left = -np.expm1(log_p)
            for n, (a, prefix, (_, used, spent, everything)) in enumerate(zip(begins.tolist(), prefixes, opened, strict=True)):
                if used and sizes[n]:  # the branches at the arc that was chosen last
                    at = a + len(prefix) - 1
                    left[at] = 0.0 if everything else max(0.0, left[at] - spent)
            left[left <= 1e-15] = 0.0
            inner = np.arange(len(arcs)) - np.repeat(begins, sizes)
            with np.errstate(divide="ignore"):
                noise = np.log(left) + _gumbel(uniform(np.repeat(_subkeys(own, 1 << 40), sizes), inner))
            noise += total - log_p
            for n, t in enumerate(texts):
                a, b = int(begins[n]), int(ends[n])
                value, used, _, _ = opened[n]
                before = float(total[a - 1]) if a else 0.0
                at = len(prefixes[n]) - 1 if used else 0
                mine = noise[a:b] - before
                mine[:at] = -np.inf
                paths[t].append({
                    "arcs": arcs[a:b], "value": value, "at": at, "used": used, "noise": mine, "best": _best(mine, value),
                    "log_p": float(total[b - 1]) - before if b > a else 0.0,
                })

        everyone = list(range(len(words)))
        none = np.zeros(0, dtype=np.int64)
        if everyone:
            roots = _gumbel(uniform(_subkeys(seeds, 1 << 41), 0)).tolist()
            extend(everyone, [none] * len(words), words, [(v, [], 0.0, False) for v in roots], 0)
        out: list = [None] * len(words)
        for turn in range(1, k + 1):
            chosen = uniform(_subkeys(seeds, 1 << 42), turn).tolist() if turn < k else []
            texts, prefixes, rest, opened = [], [], [], []
            for t in everyone:
                if out[t] is not None:
                    continue
                best = max(paths[t], key=lambda p: p["best"][0])
                value, i = best["best"]
                if turn == k or value == -np.inf:
                    out[t] = [(p["arcs"], p["log_p"], _inclusion(p["log_p"], value)) for p in paths[t]]
                    continue
                best["noise"][i] = -np.inf
                best["best"] = _best(best["noise"], best["value"])
                arcs = best["arcs"]
                node = int(np.searchsorted(store.first[: store.nodes + 1], store.first.dtype.type(arcs[i]), "right")) - 1
                used = best["used"] if i == best["at"] and best["used"] else [int(arcs[i])]
                choices = [a for a in range(store.first[node], store.first[node + 1]) if a not in used]
                weights = [exp(store.log_p[a]) for a in choices]
                mark, arc = chosen[t] * sum(weights), choices[-1]
                for a, w in zip(choices, weights, strict=True):
                    mark -= w
                    if mark < 0:
                        arc = a
                        break
                done = int((store.to[arcs[:i]] == 0).sum())
                jump = int(store.to[arc])
                on = [node + jump] if jump else []
                texts.append(t)
                prefixes.append(np.append(arcs[:i], arc))
                rest.append(np.concatenate([np.array(on, dtype=np.int64), words[t][done + 1 :]]))
                opened.append((value, [*used, arc], sum(exp(store.log_p[a]) for a in used), len(choices) == 1))
            if texts:
                extend(texts, prefixes, rest, opened, turn)
        return out

    def ids(self, paths: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all paths, one after the other, and where each path's begin, with the end of the last."""
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype(np.int64)
        numbers = self.store.emit[np.concatenate(paths)] if paths else np.zeros(0, dtype=np.int32)
        odd = np.flatnonzero(numbers >= self.vocabulary)
        if not len(odd):
            return numbers.astype("<u4"), bounds
        sizes = np.ones(len(numbers), dtype=np.int64)
        spelled = [self.spelled_ids[n - self.vocabulary] for n in numbers[odd].tolist()]
        sizes[odd] = [len(s) for s in spelled]
        ends = np.cumsum(sizes)
        out = np.repeat(numbers, sizes).astype("<u4")
        out[_ranges((ends - sizes)[odd], sizes[odd])] = [i for s in spelled for i in s]
        return out, np.concatenate([[0], ends])[bounds]

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The text of each part of ``ids``, in UTF-8, with the space that stands before every text."""
        at = ids.astype(np.int64)
        sizes = self.shown_size[at]
        whole = self.shown[_ranges(self.shown_at[at], sizes)].tobytes()
        cuts = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        return [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _best(noise: np.ndarray, value: float) -> tuple[float, int]:
    """The largest of a path's branches, drawn below its own value, and its place."""
    if not len(noise):
        return -np.inf, -1
    i = int(noise.argmax())
    top = float(noise[i])
    if top == -np.inf:
        return -np.inf, -1
    a, b = max(-value, -top), min(-value, -top)
    return -(a + log(1 + exp(b - a))), i


def _inclusion(log_p: float, kappa: float) -> float:
    x = log_p - kappa
    return 0.0 if kappa == -np.inf else x if x < -30 else log(max(-expm1(-exp(min(x, 700.0))), 1e-300))


def _grown(array: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    if used + len(new) > len(array):
        array = np.concatenate([array[:used], np.zeros(used + 4 * len(new) + 1024, dtype=array.dtype)])
    array[used : used + len(new)] = new
    return array


_lattices: dict[tuple, Lattice] = {}


def _lattice(path: str, temperature: float, penalty: float) -> Lattice:
    key = (path, temperature, penalty)
    if key not in _lattices:
        _lattices[key] = Lattice(path, temperature, penalty)
    return _lattices[key]


def sample_texts(lattice: Lattice, keys: list, texts: list[str], k: int) -> pa.RecordBatch:
    """The rows of ``sample_pieces`` for some texts; the first column is the text's position."""
    seeds = np.array([xxhash.xxh64_intdigest(str(x).encode(), 0) for x in keys], dtype=np.uint64)
    found = lattice.sample(lattice.words(texts), k, seeds)
    paths = [p for own in found for p, _, _ in own]
    ids, bounds = lattice.ids(paths)
    back = lattice.decoded(ids, bounds)
    at = [i for i, own in enumerate(found) for _ in own]
    whole = [(" " + t.replace(SPACE, " ")).encode() if t else b"" for t in texts]
    cuts, raw = bounds.tolist(), memoryview(ids).cast("B")
    return pa.RecordBatch.from_arrays(
        [
            pa.array(at, pa.int64()), pa.array([n + 1 for own in found for n in range(len(own))], pa.int32()),
            pa.array(np.diff(bounds)), pa.array([x for own in found for _, x, _ in own], pa.float64()),
            pa.array([x for own in found for _, _, x in own], pa.float64()),
            pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.int64()),
            pa.array([b == whole[i] for i, b in zip(at, back, strict=True)], pa.bool_()),
            pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view("<i4"))),
        ],
        names=["at", "sample", "n_pieces", "log_prob", "log_inclusion", "ids_crc32", "round_trip", "ids"],
    )


def sample_pieces(
    docs: DataFrame, k: int = 2, path: str | None = None, temperature: float = TEMPERATURE, penalty: float = PENALTY,
) -> DataFrame:
    """``doc_id, sample, n_pieces, log_prob, log_inclusion, ids_crc32, round_trip, ids``: k distinct segmentations of
    each text, in the order of their perturbed log-probabilities; ``round_trip``: the ids decode to the text."""
    path = path or tokenizer_path("piece_bpe_32k.model")
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(path, temperature, penalty)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= CHARS):
                    size += len(texts[end])
                    end += 1
                rows = sample_texts(lattice, keys[begin:end], texts[begin:end], k)
                own = batch.column(0).slice(begin, end - begin).take(rows.column(0))
                yield pa.RecordBatch.from_arrays([own, *rows.columns[1:]], names=["doc_id", *rows.schema.names[1:]])
                begin = end

    schema = (
        f"doc_id {id_type.simpleString()}, sample int, n_pieces long, log_prob double, log_inclusion double, ids_crc32 long, "
        "round_trip boolean, ids array<int>"
    )
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, schema)


def _by_library(df: DataFrame, column: str, out: str, call, path: str | None) -> DataFrame:
    path = path or tokenizer_path("piece_bpe_32k.model")
    id_type = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in batches:
            made = call(sp, batch.column(1).to_pylist())
            kind = pa.list_(pa.int32()) if out == "ids" else pa.string()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, kind)], names=["doc_id", out])

    return df.select("doc_id", column).mapInArrow(run, f"doc_id {id_type}, {out} {'array<int>' if out == 'ids' else 'string'}")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids``: the library's own segmentation of each text."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return _by_library(rows, "text", "ids", lambda sp, texts: sp.encode(texts, num_threads=1) if texts else [], path)


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give ''."""
    rows = rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return _by_library(rows, "ids", "text", lambda sp, ids: [sp.decode(x) if x else "" for x in ids], path)
