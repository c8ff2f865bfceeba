"""SentencePiece encoding and decoding, with distinct sampled segmentations by perturbed A-star search (Gumbel top-k).

A text's lattice has an edge for each piece at each place. Pieces never reach over a run of spaces, so the lattice is a
chain of small ones, a unit for each word with the spaces before it. Backward sums over each different unit give the
probability of every edge given its start; a segmentation's probability is the product along its path.

Sampling without replacement is a best-first search. Every set of segmentations gets a Gumbel-perturbed log probability;
the root's is drawn freely, and when a set is split, the parts' values are drawn so that their largest is the whole's.
Following the largest child from a set gives its best segmentation, and all that branches off on the way stays in the
frontier as "the rest of the edges at this place". The next segmentation is the best of the frontier. Values are exact
bounds and every branch has one (those with under a millionth of their path's mass are left out), so the search takes out segmentations in falling order, all distinct, and the best value
left over gives each one's inclusion score. Random numbers are hashes of (row key, round, place), so a row's samples don't hang on others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kneser_ney import Lookup
from .shared import HELD, Hasher, mixed, only, sorted_in, steps, strings

SAMPLES = 2
#: Text bytes whose units share a lattice; its arrays take over a hundred times as many.
STEP = 1 << 19
SPACE = 0x2581
#: A space sign in the text itself: not the pieces' sign of a space, so its bytes are encoded.
LITERAL = 0x110000
CHARS = Hasher(909)
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Vocabulary:
    """Pieces with log probabilities: falling with the rank of the piece's score, as words' frequencies do (1 / (rank + 2))."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        usable = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ranked = sorted(usable, key=lambda i: (-model.get_score(i) if model.get_score(i) > -1e8 else 0.0, i))
        weights = 1.0 / (np.arange(len(ranked)) + 2.0)
        logs = np.log(weights / (weights.sum() + 256 * weights[-1]))
        self.byte_log = float(logs[-1])
        self.log = np.full(n, self.byte_log)
        self.log[ranked] = logs
        self.longest = max(len(self.pieces[i]) for i in usable)
        known: dict[str, int] = {}
        for i in usable:
            for k in range(1, len(self.pieces[i])):
                known.setdefault(self.pieces[i][:k], -1)
            known[self.pieces[i]] = i
        codes = [np.frombuffer(p.encode("utf-32-le"), np.uint32) for p in known]
        ends = np.cumsum([len(c) for c in codes])
        # pieces and their beginnings (-1): a span that isn't even a beginning needs no longer look
        self.table = Lookup(code_spans(code_sums(np.concatenate(codes)), ends - [len(c) for c in codes], ends), np.array(list(known.values()), np.float32), hashed=True)
        shown = [p.replace("▁", " ").encode() for p in self.pieces]
        for b, i in self.bytes.items():
            shown[i] = bytes([b])
        self.shown = pa.array(shown, pa.large_binary())
        self.ascii_ids = np.array([self.bytes[b] for b in range(0x80)], np.int32)
        self.store = Store(self)

    def decoded(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """UTF-8 bytes of pieces, one after another, and where each piece's begin (one more entry than pieces)."""
        taken = self.shown.take(pa.array(ids, pa.int64()))
        at = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1]
        return taken.buffers()[2].to_pybytes() if taken.buffers()[2] is not None else b"", at

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text that pieces stand for; bytes that aren't UTF-8 together become replacement signs."""
        return self.decoded(np.asarray(ids, np.int64))[0].decode("utf-8", "replace")[1:]  # the first space is the encoder's own


def code_sums(codes: np.ndarray) -> np.ndarray:
    return CHARS.prefix(mixed(codes.astype(np.uint64) + np.uint64(1)))


def code_spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of code points."""
    CHARS.grow(len(sums))
    return mixed((sums[ends] - sums[starts]) * CHARS.inverses[starts] + (ends - starts).astype(np.uint64))


VOCABULARIES: dict[str, Vocabulary] = {}
HELD["pieces"] = VOCABULARIES.clear


def vocabulary(path: str) -> Vocabulary:
    if path not in VOCABULARIES:
        VOCABULARIES[path] = Vocabulary(path)
    return VOCABULARIES[path]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after another."""
    total = np.cumsum(sizes)
    return np.repeat(starts - total + sizes, sizes) + np.arange(int(total[-1]) if len(total) else 0)


class Store:
    """Edges of the units that a worker has met, so that a common word's lattice is made once, not once a batch.

    log, chance and piece have a row for each edge length and a column for each place (a character of a unit). It starts
    anew when it is full; a batch that needs more than ROOM has it all the same.
    """

    ROOM = 1_500_000

    def __init__(self, v: Vocabulary):
        self.v = v
        self.clear(self.ROOM)

    def clear(self, room: int) -> None:
        self.hashes, self.begins, self.used, self.room = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, room
        self.codes, self.left = np.empty(room, np.int32), np.empty(room, np.int32)  # left: characters up to the unit's end
        self.log, self.chance, self.piece = (np.empty((self.v.longest, room), kind) for kind in (np.float32, np.float32, np.int32))

    def places(self, hashes: np.ndarray, start: np.ndarray, stop: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Where the units with these (sorted, different) hashes begin; start and stop are their ranges in codes."""
        new = np.flatnonzero(~sorted_in(hashes, self.hashes))
        if self.used + int((stop - start)[new].sum()) > self.room:
            new = np.arange(len(hashes))
            self.clear(max(self.ROOM, int((stop - start).sum())))
        size = (stop - start)[new]
        if len(new):
            begin = self.used + np.cumsum(size) - size
            here = slice(self.used, self.used + int(size.sum()))
            self.codes[here] = codes[ranges(start[new], size)]
            self.left[here] = np.repeat(begin + size, size) - np.arange(here.start, here.stop)
            self.edges(here)
            self.used = here.stop
            at = np.searchsorted(self.hashes, hashes[new])
            self.hashes, self.begins = np.insert(self.hashes, at, hashes[new]), np.insert(self.begins, at, begin)
        return self.begins[np.searchsorted(self.hashes, hashes)]

    def edges(self, here: slice) -> None:
        v, codes, left = self.v, self.codes[here].astype(np.int64), self.left[here]
        n, sums = len(codes), code_sums(codes)
        log, piece = self.log[:, here], self.piece[:, here]
        log[:], piece[:] = -np.inf, -1
        i, wide = np.arange(n), 1
        for k in range(1, v.longest + 1):
            i = i[left[i] >= k]
            value, found = v.table.get(code_spans(sums, i, i + k))
            i, ids = i[found], value[found].astype(np.int32)
            if not len(i) and k > 1:
                break
            whole = ids >= 0
            log[k - 1, i[whole]], piece[k - 1, i[whole]] = v.log[ids[whole]], ids[whole]
            wide = k
        alone = np.flatnonzero(piece[0] < 0)  # not a piece: its bytes
        c = codes[alone]
        log[0, alone] = v.byte_log * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000) - (c == LITERAL))
        ascii_only = alone[c < 0x80]
        piece[0, ascii_only] = v.ascii_ids[codes[ascii_only]]
        ahead = np.zeros(n + wide + 1)  # log sum over all ways from here to the unit's end
        order = np.argsort(left, kind="stable")
        cuts = np.searchsorted(left[order], np.arange(1, int(left.max(initial=0)) + 2))
        for r in range(len(cuts) - 1):  # the places that are r + 1 characters before their unit's end
            i = order[cuts[r] : cuts[r + 1]]
            x = [log[k, i] + ahead[i + k + 1] if k < r else log[k, i].astype(np.float64) for k in range(min(wide, r + 1))]
            top = np.maximum.reduce(x)
            total = np.exp(x[0] - top)
            for y in x[1:]:
                total += np.exp(y - top)
            ahead[i] = whole = top + np.log(total)
            for k, y in enumerate(x):
                log[k, i] = y - whole
        chance = self.chance[:, here]
        np.exp(log[0], out=chance[0])
        for k in range(1, len(chance)):
            chance[k] = chance[k - 1]
            if k < wide:
                i = np.flatnonzero(log[k] > -np.inf)
                chance[k, i] += np.exp(log[k, i])


class Lattice:
    """Units of a batch of texts, and where each one's edges are in the store."""

    def __init__(self, v: Vocabulary, texts: list[str]):
        raw = [t.encode("utf-32-le") for t in texts]
        sizes = np.array([len(r) // 4 + 1 for r in raw], np.int64)
        ends = np.cumsum(sizes)
        codes = np.frombuffer(b"".join(x for r in raw for x in (b" \0\0\0", r)), np.uint32).astype(np.int64)
        codes = np.where(codes == SPACE, LITERAL, np.where(codes == 0x20, SPACE, codes))
        space = codes == SPACE
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[ends[:-1]] = True
        start = np.flatnonzero(begins)
        stop = np.append(start[1:], len(codes))
        self.of_text = np.searchsorted(start, np.append(ends - sizes, len(codes)))  # each text's first unit
        hashes, first, unit = np.unique(code_spans(code_sums(codes), start, stop), return_index=True, return_inverse=True)
        self.begin = v.store.places(hashes, start[first], stop[first], codes)[unit]
        self.left, self.codes, self.log, self.chance, self.piece = v.store.left, v.store.codes, v.store.log, v.store.chance, v.store.piece


def place_keys(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mixed(key + place.astype(np.uint64) * A)


def drawn(place_key: np.ndarray, turn: int, what: int) -> np.ndarray:
    """Numbers in (0, 1) from row key and place, round and purpose."""
    h = mixed(place_key + np.uint64((turn * int(B) + what * int(C)) % 2**64))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def uniform(key: np.ndarray, turn: int, place: np.ndarray, what: int) -> np.ndarray:
    return drawn(place_keys(key, place), turn, what)


class Paths:
    """One segmentation for each of some texts: places in the lattice, lengths, and units' numbers of their edges, flat."""

    def __init__(self, lattice: Lattice, at: np.ndarray, size: np.ndarray, unit: np.ndarray, counts: np.ndarray):
        self.at, self.size, self.unit, self.counts = at, size, unit, counts
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.log = lattice.log[size - 1, at].astype(np.float64)
        sums = np.concatenate([[0.0], np.cumsum(self.log)])
        self.total = sums[self.first[1:]] - sums[self.first[:-1]]
        self.before = sums[:-1] - sums[self.first[:-1]][self.text]  # log probability of the edges before each one
        self.place = np.arange(len(at)) - self.first[:-1][self.text]


def walks(lattice: Lattice, place_key: np.ndarray, turn: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Free samples from each state to its unit's end: (index into states, place, edge length), in order of index and step."""
    found, counts, step = [], np.zeros(len(state), np.int64), 0
    index, here, chance = np.arange(len(state)), state, lattice.chance
    while len(index):
        u = (drawn(place_key, turn, step) * chance[-1][here]).astype(np.float32)
        k, on, of, v = np.ones(len(here), np.int64), np.arange(len(here)), here, u
        for row in chance[:-1]:
            more = row[of] < v
            on, of, v = on[more], of[more], v[more]
            if not len(on):
                break
            k[on] += 1
        found.append((index, here, k))
        counts[index] += 1
        on = lattice.left[here] > k
        index, here, place_key = index[on], (here + k)[on], place_key[on]
        step += 1
    first = np.cumsum(counts) - counts
    at, size = np.zeros(int(counts.sum()), np.int64), np.zeros(int(counts.sum()), np.int64)
    for step, (index, here, k) in enumerate(found):
        to = first[index] + step
        at[to], size[to] = here, k
    return np.repeat(np.arange(len(state)), counts), at, size


def truncated(log_mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values of sets with these log masses, given that none is above the bound."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        out = log_mass - np.log(-np.log(u) + np.exp(log_mass - bound))
    return np.where(np.isfinite(log_mass), np.minimum(out, bound), -np.inf)


def branches(p: Paths, keys: np.ndarray, turn: int, fresh: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Values of the sets that branch off each path at each of its places; -inf before place `fresh`."""
    miss = -np.expm1(np.minimum(p.log, 0.0))
    with np.errstate(divide="ignore"):
        mass = np.where((miss < 1e-6) | (p.place < fresh[p.text]), -np.inf, p.before + np.log(miss))
    out = np.full(len(mass), -np.inf)
    i = np.flatnonzero(mass > -np.inf)
    out[i] = truncated(mass[i], bound[p.text[i]], uniform(keys[p.text[i]], turn, p.place[i], 1 << 21))
    return out


def most_of(values: np.ndarray, p: Paths) -> np.ndarray:
    """The largest value of each text's path (no path: -inf)."""
    out, there = np.full(len(p.counts), -np.inf), np.flatnonzero(p.counts)
    if len(there):
        out[there] = np.maximum.reduceat(values, p.first[there])
    return out


def sampled(v: Vocabulary, texts: list[str], keys: np.ndarray, samples: int = SAMPLES) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to `samples` distinct segmentations, best first: (ids, log probability, perturbed value, log inclusion score).

    Each round takes one more segmentation of every text at once. A set that has no probability to speak of (below 1e-6
    of its path's) is no branch.
    """
    lattice = Lattice(v, texts)
    n = len(texts)
    units = np.diff(lattice.of_text)
    text_of = np.repeat(np.arange(n), units)
    unit_no = np.arange(len(text_of)) - lattice.of_text[:-1][text_of]
    unit_keys, begin = place_keys(keys[text_of], unit_no), lattice.begin
    who, at, size = walks(lattice, unit_keys, 0, begin)
    paths = [Paths(lattice, at, size, unit_no[who], np.bincount(text_of[who], minlength=n))]
    values = [-np.log(-np.log(uniform(keys, 0, np.zeros(n), 1 << 20)))]
    fronts: list[np.ndarray] = []
    tops: list[np.ndarray] = []
    gone: dict[tuple[int, int, int], set[int]] = {}  # edges at a text's path's place that other paths have taken
    fresh = np.zeros(n, np.int64)  # sets before this place are the frontier's already
    for turn in range(1, samples + 1):
        fronts.append(branches(paths[-1], keys, turn, fresh, values[-1]))
        tops.append(most_of(fronts[-1], paths[-1]))
        bound = np.max(tops, 0)
        if turn == samples:
            break
        go, best = np.flatnonzero(bound > -np.inf), np.argmax(tops, 0)
        place, state, own, unit, before = (np.zeros(n, x) for x in (np.int64, np.int64, np.int64, np.int64, float))
        for r in np.unique(best[go]).tolist():
            t, p = go[best[go] == r], paths[r]
            hits = np.flatnonzero(fronts[r] == bound[p.text])
            i = hits[np.searchsorted(hits, p.first[t])]
            place[t], state[t], own[t], unit[t], before[t] = p.place[i], p.at[i], p.size[i], p.unit[i], p.before[i]
        chance = np.exp(lattice.log[:, state[go]].astype(np.float64))
        row = np.arange(len(go))
        chance[own[go] - 1, row] = 0.0
        names = list(zip(best[go].tolist(), go.tolist(), place[go].tolist(), strict=True))
        for i, name in enumerate(names):
            for k in gone.get(name, ()):
                chance[k - 1, i] = 0.0
        u = uniform(keys[go], turn, place[go], 1 << 22)
        sums = np.cumsum(chance, 0)
        k = np.minimum((sums < u * sums[-1]).sum(0), len(chance) - 1) + 1
        for name, x in zip(names, k.tolist(), strict=True):
            gone.setdefault(name, set()).add(x)
        chance[k - 1, row] = 0.0
        rest = chance.sum(0)
        with np.errstate(divide="ignore"):
            again = np.where(rest > 1e-12, np.log(rest) + before[go], -np.inf)
        again = truncated(again, bound[go], uniform(keys[go], turn, place[go], 1 << 23))
        for r in np.unique(best[go]).tolist():
            mine = best[go] == r
            fronts[r][paths[r].first[go[mine]] + place[go[mine]]] = again[mine]
            tops[r] = most_of(fronts[r], paths[r])
        # the new paths: as before up to the place, the new edge, and free walks over what is left of its unit and the rest
        left = lattice.left[state[go]] > k
        ahead = np.zeros(n, np.int64)
        ahead[go] = (units - unit - 1)[go]
        tail = ranges(lattice.of_text[:-1][go] + unit[go] + 1, ahead[go])
        t = np.concatenate([go[left], text_of[tail]])
        of_unit = np.concatenate([unit[go][left], unit_no[tail]])
        order = np.lexsort((of_unit, t))
        start = np.concatenate([(state[go] + k)[left], begin[tail]])[order]
        key = np.concatenate([place_keys(keys[go[left]], unit[go][left] + (1 << 32)), unit_keys[tail]])[order]
        who, at, size = walks(lattice, key, turn, start)
        t, of_unit = t[order][who], of_unit[order][who]
        counts = np.bincount(t, minlength=n)
        walked = counts[go]
        counts[go] += place[go] + 1
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        flat = [np.zeros(int(counts.sum()), np.int64) for _ in range(3)]
        for r in np.unique(best[go]).tolist():
            mine = go[best[go] == r]
            to, source = ranges(first[mine], place[mine]), ranges(paths[r].first[mine], place[mine])
            for x, y in zip(flat, (paths[r].at, paths[r].size, paths[r].unit), strict=True):
                x[to] = y[source]
        to = ranges(first[go] + place[go] + 1, walked)
        for x, y, z in zip(flat, (state[go], k, unit[go]), (at, size, of_unit), strict=True):
            x[first[go] + place[go]], x[to] = y, z
        paths.append(Paths(lattice, *flat, counts))
        values.append(np.where(bound > -np.inf, bound, np.nan))
        fresh = place + 1
    out: list[list[tuple[np.ndarray, float, float, float]]] = [[] for _ in range(n)]
    for p, g in zip(paths, values, strict=True):
        ids, first = piece_ids(v, lattice, p)
        for t in np.flatnonzero(p.counts).tolist():
            log_p = float(p.total[t])
            out[t].append((ids[first[t] : first[t + 1]], log_p, float(g[t]), log_inclusion(log_p, float(bound[t]))))
    return out


def log_inclusion(log_p: float, threshold: float) -> float:
    """Log of the probability that a segmentation's value is above the best one that was left out."""
    if threshold == -np.inf:
        return 0.0
    x = np.exp(min(log_p - threshold, 700.0))
    return float(log_p - threshold) if x < 1e-12 else float(np.log(-np.expm1(-x)))


def piece_ids(v: Vocabulary, lattice: Lattice, p: Paths) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all paths, one after another, and where each text's begin; a character that is no piece is its bytes."""
    ids, size = lattice.piece[p.size - 1, p.at], np.ones(len(p.at), np.int64)
    odd = np.flatnonzero(ids < 0)
    spelled = [[v.bytes[x] for x in chr(SPACE if c == LITERAL else c).encode()] for c in lattice.codes[p.at[odd]].tolist()]
    size[odd] = [len(x) for x in spelled]
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.repeat(ids, size)
    if len(odd):
        out[ranges(ends[:-1][odd], size[odd])] = [x for s in spelled for x in s]
    return out, ends[p.first]


def sample_segmentations(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(doc_id, sample, ids, log_prob, perturbed, log_inclusion, decoded): up to `samples` distinct segmentations of each text, best first.

    decoded tells whether the pieces give the text back. Null text counts as empty, which has one segmentation, that of
    the encoder's own first space; a text with fewer segmentations than asked for gives all of them. Rows with equal
    doc_id and text have equal samples; null ids are keyed by the text; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("pieces")
        v = vocabulary(model_path)
        names = ["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", "decoded"]
        kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
        for b in batches:
            texts = strings(b.column(2))
            doc_ids, keys = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for first, end, _, _ in steps(texts, STEP):
                part = texts[first:end].to_pylist()
                found = sampled(v, part, keys[first:end], samples)
                ids = [x[0] for rows in found for x in rows]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                flat = np.concatenate(ids)
                raw, at = v.decoded(flat)
                at, rows, n = at[ends].tolist(), [], 0
                for doc_id, text, own in zip(doc_ids[first:end], part, found, strict=True):
                    want = b" " + text.encode()
                    for i, (_, p, g, q) in enumerate(own):
                        rows.append((doc_id, i, p, g, q, raw[at[n] : at[n + 1]] == want))
                        n += 1
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                columns.insert(2, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, decoded boolean"
    key = F.xxhash64(F.col(id_col).cast("long"), F.when(F.col(id_col).isNull(), F.col(text_col)))
    return docs.select(F.col(id_col).cast("long"), key, F.col(text_col)).mapInArrow(run, schema)

def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the model's own segmentation of each whole text, in the order of its merges.

    Null text counts as empty, which has no pieces; repeated rows and null ids are rows like others; an empty table gives
    an empty result; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        only()
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.encode(strings(b.column(1)).to_pylist(), num_threads=1), pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(pieces: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the text that each list of pieces stands for; bytes that aren't UTF-8 together become replacement signs.

    A null list counts as empty, which is the empty text; null ids within a list are left out; repeated rows and null
    doc_ids are rows like others; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("pieces")
        v = vocabulary(model_path)
        for b in batches:
            texts = [v.decode([x for x in ids or () if x is not None]) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pieces.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
