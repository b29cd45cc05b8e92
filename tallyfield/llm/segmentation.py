"""SentencePiece segmentations sampled without replacement: Gumbel top-k by perturbed A-star search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_between, mix64, prefix_sums, raw_between, release, slices, string_buffers

_BAR = 0x2581  # the sign that stands for a space in pieces
_G1, _G2, _G3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_REACH = 37.0  # no Gumbel number from 53 random bits lies further above its location
_state: dict = {}


def _uniform(keys: np.ndarray) -> np.ndarray:
    return ((mix64(keys) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _times(n: int, by: np.uint64) -> np.uint64:
    return np.uint64(n * int(by) % (1 << 64))


class Vocabulary:
    """Pieces of a SentencePiece model with log probabilities: a Zipf law over the order in which they were merged."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        ranks = np.full(n, np.inf)
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        written = [b""] * n
        self.byte_ids = np.zeros(256, np.int64)
        for i in range(n):
            if sp.is_control(i) or sp.is_unknown(i):
                continue
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], written[i], ranks[i] = i, bytes([value]), n
            else:
                ranks[i] = min(-sp.get_score(i), n)
                written[i] = piece.replace("▁", " ").encode()
                by_length.setdefault(len(piece), []).append((np.frombuffer(piece.encode("utf-32-le"), np.uint32), i))
        # Control characters inside pieces of several characters; nothing reaches across the others.
        self.joined = np.isin(np.arange(0x20), np.concatenate([p for size, f in by_length.items() if size > 1 for p, _ in f]))
        weights = 1 / (ranks + 2)
        with np.errstate(divide="ignore"):
            self.logp = np.log(weights / weights.sum())
        self.pieces, self.seen = {}, {}
        for length, found in by_length.items():
            flat = np.concatenate([p for p, _ in found])
            starts = np.arange(len(found)) * length
            keys = raw_between(prefix_sums(flat), starts, starts + length)
            order = np.argsort(keys)
            self.seen[length] = np.zeros(1 << 18, bool)
            self.seen[length][keys >> np.uint64(46)] = True
            self.pieces[length] = keys[order], np.array([i for _, i in found])[order]
        self.bytes = np.frombuffer(b"".join(written), np.uint8)
        self.sizes = np.array([len(w) for w in written])
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        self.lattice = Lattice(self)


def vocabulary(path: str) -> Vocabulary:
    if path not in _state:
        _state[path] = Vocabulary(path)
    return _state[path]


class Lattice:
    """All segmentations of many units (a space and the word after it), as edges; those of one start lie together.

    ``log`` is the log of an edge's probability given its start when whole segmentations are drawn from the model.
    Units are remembered between batches from their second time on, as words recur and most others never do; those
    that come first stay until the next call.  All are forgotten before they exceed ``most`` characters, some 60 bytes each.
    """

    EDGES = {"start": np.int32, "after": np.int32, "id": np.int32, "log": np.float64}
    POINTS = {"first": np.int32, "size": np.int32}

    def __init__(self, vocab: Vocabulary, most: int = 800_000):
        self.vocab, self.most = vocab, most
        self.forget()

    def forget(self) -> None:
        """Give back all memory."""
        self.known, self.place, self.met = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1 << 22, bool)
        self.edges = self.points = 0
        self.kept = (0, 0)  # edges and points of remembered units
        for name, kind in (self.EDGES | self.POINTS).items():
            setattr(self, name, np.zeros(0, kind))

    def places(self, keys: np.ndarray, points: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """First characters, in this lattice, of distinct units: spans of ``points`` with sorted hashes ``keys``."""
        self.edges, self.points = self.kept
        sizes, mark = ends - begins, keys >> np.uint64(42)
        again = self.met[mark]
        self.met[mark] = True
        new = self._unknown(keys)
        if self.points + sizes[new[again[new]]].sum() > self.most:
            self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.edges, self.points = self.kept = (0, 0)
            new = self._unknown(keys)
            if sizes[again].sum() > self.most:
                again = np.zeros(len(keys), bool)
        out = np.zeros(len(keys), np.int64)
        old = np.ones(len(keys), bool)
        old[new] = False
        if old.any():
            out[old] = self.place[np.searchsorted(self.known, keys[old])]
        for which in (new[again[new]], new[~again[new]]):
            if len(which):
                bounds = np.concatenate([[0], np.cumsum(sizes[which])])
                out[which] = self.points + bounds[:-1]
                self._add(points[np.arange(bounds[-1]) + np.repeat(begins[which] - bounds[:-1], sizes[which])], bounds)
                if again[which[0]]:
                    self.kept = (self.edges, self.points)
                    at = np.searchsorted(self.known, keys[which])
                    self.known, self.place = np.insert(self.known, at, keys[which]), np.insert(self.place, at, out[which])
        return out

    def _unknown(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.arange(len(keys))
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return np.flatnonzero(self.known[at] != keys)

    def _append(self, total: int, values: dict) -> None:
        for name, new in values.items():
            old = getattr(self, name)
            if total + len(new) > len(old):  # room for three edges a character: pages that are never written cost nothing
                room = (self.most + (1 << 19)) * (3 if name in self.EDGES else 1)
                more = np.empty(max(total + len(new), room, len(old) * 3 // 2), old.dtype)
                more[:total] = old[:total]
                setattr(self, name, more)
            getattr(self, name)[total : total + len(new)] = new

    def _add(self, points: np.ndarray, bounds: np.ndarray) -> None:
        """Append the edges of units that lie one after the other in ``points``."""
        vocab, n = self.vocab, len(points)
        end = np.repeat(bounds[1:], np.diff(bounds))
        sums, place = prefix_sums(points), np.arange(n)
        starts, lengths, ids = [], [], []
        single = np.zeros(n, bool)
        for length, (keys, piece) in sorted(vocab.pieces.items(), reverse=True):  # longer pieces first: mostly likelier
            at = place[place + length <= end]
            wanted = raw_between(sums, at, at + length)
            maybe = np.flatnonzero(vocab.seen[length][wanted >> np.uint64(46)])  # spares most searches
            at, wanted = at[maybe], wanted[maybe]
            found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[found] == wanted
            starts.append(at[hit])
            lengths.append(np.full(hit.sum(), length))
            ids.append(piece[found[hit]])
            if length == 1:
                single[at[hit]] = True
        strange = np.flatnonzero(~single)  # characters without a piece of their own: their bytes, in one step
        size = 1 + (points[strange] > 0x7F) + (points[strange] > 0x7FF) + (points[strange] > 0xFFFF)
        start = np.concatenate([*starts, strange])
        length = np.concatenate([*lengths, np.ones(len(strange), np.int64)])
        ids_ = np.concatenate([*ids, -1 - points[strange].astype(np.int64)])
        logp = np.concatenate([vocab.logp[np.concatenate(ids)] if ids else np.zeros(0), size * vocab.logp[vocab.byte_ids[0]]])
        after = start + length
        distance = end[start] - start
        # Edges by distance of their start from the unit's end, then by start: those of a start lie together.
        deepest = int(distance.max(initial=0))
        order = np.argsort(start.astype(np.int32), kind="stable")
        order = order[np.argsort(distance[order].astype(np.int16 if deepest < 1 << 15 else np.int64), kind="stable")]
        start, after, value, distance = start[order], after[order], logp[order], distance[order]
        more = after != end[start]
        opens = np.ones(len(order), bool)
        opens[1:] = start[1:] != start[:-1]
        heads = np.flatnonzero(opens)
        first, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        first[start[heads]], size[start[heads]] = heads, np.diff(np.append(heads, len(order)))
        # Log of the sum over all ways to the unit's end, from the last character of every unit backwards.
        layers = np.searchsorted(distance, np.arange(1, deepest + 2))
        first_heads = np.searchsorted(heads, layers)
        beta = np.zeros(n + 1)
        for layer, (lo, hi) in enumerate(zip(layers[:-1], layers[1:], strict=True)):
            if lo == hi:
                continue
            onward = lo + np.flatnonzero(more[lo:hi])
            value[onward] += beta[after[onward]]
            head = heads[first_heads[layer] : first_heads[layer + 1]]
            total = np.add.reduceat(np.exp(value[lo:hi]), head - lo)
            tiny = total < 1e-290  # in units of hundreds of characters
            if tiny.any():
                beta[start[head]] = np.where(tiny, np.logaddexp.reduceat(value[lo:hi], head - lo), np.log(np.maximum(total, 1e-290)))
            else:
                beta[start[head]] = np.log(total)
        log = value - beta[start]
        self._append(self.edges, {"start": start + self.points, "after": after + self.points, "id": ids_[order], "log": log})
        self._append(self.points, {"first": first + self.edges, "size": size})
        self.edges, self.points = self.edges + len(order), self.points + n

    def draw(self, pos: np.ndarray, end: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of one random segmentation from ``pos`` to ``end`` for each row, and how many each has."""
        steps, counts = [], np.zeros(len(pos), np.int64)
        active = np.flatnonzero(pos < end)
        at, step = pos[active], 0
        while len(active):
            rest = _uniform(keys[active] + _times(step, _G3))
            edge = self.first[at].copy()
            most = edge + self.size[at] - 1
            rest -= np.exp(self.log[edge])
            wrong = np.flatnonzero((rest >= 0) & (edge < most))
            while len(wrong):
                edge[wrong] += 1
                rest[wrong] -= np.exp(self.log[edge[wrong]])
                wrong = wrong[(rest[wrong] >= 0) & (edge[wrong] < most[wrong])]
            steps.append((active, edge))
            counts[active] += 1
            at = self.after[edge]
            more = at < end[active]
            active, at = active[more], at[more]
            step += 1
        first = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(first[-1], np.int64)
        for step, (rows, edge) in enumerate(steps):
            out[first[rows] + step] = edge
        return out, counts


def _units(vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray):
    """Code points with spaces written as the bar and a bar before each text, first points of texts and of units."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).copy()
    bounds = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offsets)
    points[points == 0x20] = _BAR
    filled = np.flatnonzero(np.diff(bounds))
    points = np.insert(points, bounds[filled], _BAR)
    bounds = bounds + np.concatenate([[0], np.cumsum(np.diff(bounds) > 0)])
    begins = np.zeros(len(points) + 1, bool)
    begins[bounds] = True
    bar = points == _BAR
    begins[1:-1] |= bar[1:] & ~bar[:-1]
    breaks = (points < 0x20) & ~vocab.joined[np.minimum(points, 0x1F)]
    begins[:-1] |= breaks
    begins[1:] |= breaks
    return points, bounds, np.flatnonzero(begins[:-1])


def sample_batch(vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray, row_keys: np.ndarray, k: int):
    """For samples 1 .. k: rows, ids and their counts, log probability, perturbed value; and each row's threshold."""
    rows = len(offsets) - 1
    points, bounds, begins = _units(vocab, data, offsets)
    ends = np.append(begins[1:], len(points))[: len(begins)]
    sums = prefix_sums(points)
    distinct, chosen, which = np.unique(hash_between(sums, begins, ends), return_index=True, return_inverse=True)
    lattice = vocab.lattice
    unit_start = lattice.places(distinct, points, begins[chosen], ends[chosen])[which]  # of each occurrence, in the lattice
    unit_end = unit_start + (ends - begins)
    unit_bounds = np.searchsorted(begins, bounds)  # of rows, in occurrences
    unit_row = np.repeat(np.arange(rows), np.diff(unit_bounds))
    nth = np.arange(len(unit_row)) - unit_bounds[unit_row]

    def keys_of(occurrence, sample):
        return mix64(row_keys[unit_row[occurrence]] + _times(sample, _G1)) + (nth[occurrence].astype(np.uint64) + np.uint64(1)) * _G2

    everything = np.arange(len(unit_row))
    edges, counts = lattice.draw(unit_start, unit_end, keys_of(everything, 1))
    unit = np.repeat(everything, counts)
    live = np.arange(rows)
    perturbed = -np.log(-np.log(_uniform(row_keys ^ _G2)))
    since = np.zeros(rows, np.int64)
    # Candidates: siblings of edges on the paths found so far, with their perturbed values.
    found = {name: [] for name in ("row", "g", "path", "nth", "edge")}
    paths, out = [], []
    for sample in range(1, k + 1):
        row = unit_row[unit]
        bound = np.searchsorted(row, np.arange(rows + 1))
        logp = np.bincount(row, lattice.log[edges], rows).astype(np.float64)
        paths.append((edges, bound, unit))
        out.append((live, edges, bound, logp, perturbed.copy()))
        _siblings(lattice, edges, bound, live, perturbed, since, row_keys, sample, found)
        rank = _flat(found)
        best, at = _best(rank, rows)
        if sample == k:
            break
        live = np.flatnonzero(best > -np.inf)
        pick = at[live]
        rank["g"][pick] = -np.inf  # taken
        found = {name: [values] for name, values in rank.items()}
        edges, unit, since = _deviate(lattice, paths, rank, pick, live, unit_bounds, unit_start, unit_end, keys_of, sample + 1, rows)
        perturbed = np.where(best > -np.inf, best, perturbed)
    return lattice, out, best


def _flat(found: dict) -> dict:
    kinds = {"row": np.int64, "g": np.float64, "path": np.int64, "nth": np.int64, "edge": np.int64}
    return {name: np.concatenate([np.zeros(0, kinds[name]), *values]) for name, values in found.items()}


def _best(rank: dict, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest perturbed value among each row's candidates (minus infinity: none), and where it is."""
    best, at = np.full(rows, -np.inf), np.zeros(rows, np.int64)
    np.maximum.at(best, rank["row"], rank["g"])
    top = np.flatnonzero((rank["g"] == best[rank["row"]]) & (rank["g"] > -np.inf))
    at[rank["row"][top]] = top
    return best, at


def _siblings(lattice, edges, bound, live, perturbed, since, row_keys, sample, found) -> None:
    """Perturbed values of the edges next to a path's, each below the path's own.

    A subtree of log probability f cannot exceed f + ``_REACH``.  A row is searched down to a floor and
    deeper, until no node below the floor could beat the ``sample`` + 1 best found: nothing is lost.
    """
    logs = lattice.log[edges]
    depth = np.concatenate([[0.0], np.cumsum(logs)])
    depth = depth[:-1] - np.repeat(depth[bound[:-1]], np.diff(bound))  # log probability of the path before each edge
    row_of = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
    step_of = np.arange(len(edges)) - bound[row_of]
    floor, todo = -40.0, np.zeros(len(bound) - 1, bool)
    todo[live] = True
    while todo.any():
        at = np.flatnonzero(todo[row_of] & (depth >= floor) & (step_of >= since[row_of]))
        start = lattice.start[edges[at]]
        wide = lattice.size[start]
        who = np.repeat(at, wide)
        nth = np.arange(len(who)) - np.repeat(np.cumsum(wide) - wide, wide)
        other = lattice.first[lattice.start[edges[who]]] + nth
        f = depth[who] + lattice.log[other]
        beside = other != edges[who]
        dropped = row_of[who[beside & (f < floor)]]
        keep = np.flatnonzero(beside & (f >= floor))
        who, nth, other, f = who[keep], nth[keep], other[keep], f[keep]
        row = row_of[who]
        u = _uniform(mix64(row_keys[row] + _times(sample, _G3)) + step_of[who].astype(np.uint64) * _G1 + nth.astype(np.uint64) * _G2)
        value = -np.logaddexp(-perturbed[row], np.log(-np.log(u)) - f)
        best = np.full(len(bound) - 1, -np.inf)
        np.maximum.at(best, row, value)
        # Rows with something below the floor that could still beat what was found look deeper.
        lost = np.zeros(len(bound) - 1, bool)
        lost[dropped] = True
        lost |= np.bincount(row_of, logs, len(bound) - 1) < floor
        again = todo & (best < floor + _REACH) & lost
        use = np.flatnonzero(~again[row])
        for name, values in (("row", row), ("g", value), ("path", np.full(len(row), sample - 1)), ("nth", step_of[who]), ("edge", other)):
            found[name].append(values[use])
        todo, floor = again, floor * 4


def _deviate(lattice, paths, rank, pick, live, unit_bounds, unit_start, unit_end, keys_of, sample, rows):
    """The next path of each live row: its prefix up to the candidate, the candidate, and a fresh random rest."""
    path, nth, edge = rank["path"][pick], rank["nth"][pick], rank["edge"][pick]
    since = np.zeros(rows, np.int64)
    since[live] = nth + 1
    kept_rows, kept_edges, kept_units, own = [], [], [], np.zeros(len(live), np.int64)
    for p, (edges, bound, unit) in enumerate(paths):
        mine = np.flatnonzero(path == p)
        first = bound[live[mine]]
        own[mine] = unit[first + nth[mine]]
        source = np.arange(nth[mine].sum()) + np.repeat(first - (np.cumsum(nth[mine]) - nth[mine]), nth[mine])
        kept_rows.append(np.repeat(live[mine], nth[mine]))
        kept_edges.append(edges[source])
        kept_units.append(unit[source])
    rest = unit_bounds[live + 1] - own  # the candidate's own unit, from behind it, and all units after it
    occurrence = np.arange(rest.sum()) - np.repeat(np.cumsum(rest) - rest, rest) + np.repeat(own, rest)
    begin = unit_start[occurrence]
    begin[np.cumsum(rest) - rest] = lattice.after[edge]
    drawn, counts = lattice.draw(begin, unit_end[occurrence], keys_of(occurrence, sample))
    rows_of = np.concatenate([*kept_rows, live, np.repeat(np.repeat(live, rest), counts)])
    all_edges = np.concatenate([*kept_edges, edge, drawn])
    all_units = np.concatenate([*kept_units, own, np.repeat(occurrence, counts)])
    order = np.argsort(rows_of, kind="stable")
    return all_edges[order], all_units[order], since


def _expand(vocab: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of edges, strange characters written as their bytes' pieces, and how many each edge gives."""
    strange = np.flatnonzero(ids < 0)
    sizes = np.ones(len(ids), np.int64)
    if not len(strange):
        return ids.astype(np.int32), sizes
    coded = [chr(-1 - i).encode("utf-8") for i in ids[strange].tolist()]
    sizes[strange] = [len(c) for c in coded]
    out = np.repeat(ids, sizes)
    out[np.repeat(ids < 0, sizes)] = vocab.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
    return out.astype(np.int32), sizes


ADDED = ("sample", "ids", "decoded", "log_prob", "perturbed", "log_inclusion")


def sample_segmentations(
    docs: DataFrame, model: str, k: int = 2, seed: int = 13,
    id_col: str = "doc_id", text: str = "text", carry: list[str] | None = None,
) -> DataFrame:
    """``k`` distinct random segmentations of every whole text, drawn without replacement.

    The lattice holds every way to write a text (a space before it, as the model adds one) with the
    model's pieces; characters in no piece become bytes.  Segmentations are drawn with probability
    proportional to the product of piece probabilities.  Gumbel top-k: an ancestral sample carries the
    largest perturbed log probability, every edge beside it gets one below that, and A-star search goes on
    with the largest, which is the exact bound of what lies under it.  Random numbers are hashes of the row
    key (id), so reruns agree wherever rows lie.

    One row per document and sample: the input columns (of ``carry`` only, if given), ``sample`` (1 .. k), ``ids``
    (array), ``decoded`` (the text that the ids write), ``log_prob``, ``perturbed``, and ``log_inclusion``, the log of the chance ``1 - exp(-exp(log_prob - threshold))`` to be
    among the k, with the k + 1st perturbed value as threshold (0 where there is none).  A text with fewer
    segmentations gives fewer rows; null and empty text give one row without ids.  Repeated rows repeat.
    Input columns with an added name are replaced.
    """
    added = "sample int, ids array<int>, decoded string, log_prob double, perturbed double, log_inclusion double"
    names = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    named = docs.select(*names, F.col(text).alias("_text"), F.xxhash64(F.lit(seed), id_col).alias("_key"))
    fields = [f for f in named.schema.fields[: len(names)]]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", " + added

    def run(batches):
        import pyarrow as pa

        vocab = vocabulary(model)
        try:
            for batch in batches:
                data, offsets = string_buffers(batch.column(len(names)))
                keys = batch.column(len(names) + 1).to_numpy(zero_copy_only=False).view(np.uint64)
                for lo, hi in slices(offsets, 1 << 19):
                    lattice, out, threshold = sample_batch(vocab, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], keys[lo:hi], k)
                    for sample, (live, edges, bound, logp, perturbed) in enumerate(out, 1):
                        ids, sizes = _expand(vocab, lattice.id[edges])
                        total = np.concatenate([[0], np.cumsum(sizes)])[bound]
                        beyond = np.exp(np.minimum(logp - threshold, 700))
                        with np.errstate(divide="ignore"):
                            inclusion = np.where(logp - threshold < -30, logp - threshold, np.log(-np.expm1(-beyond)))
                        within = np.append(total[live], total[live[-1] + 1] if len(live) else 0)
                        lists = pa.ListArray.from_arrays(pa.array(within.astype(np.int32)), pa.array(ids))
                        columns = [batch.column(i).slice(lo, hi - lo).take(pa.array(live)) for i in range(len(names))]
                        columns += [pa.array(np.full(len(live), sample, np.int32)), lists, _written_rows(vocab, ids, within), *(pa.array(v[live]) for v in (logp, perturbed, inclusion))]
                        yield pa.RecordBatch.from_arrays(columns, names=[*names, *ADDED])
        finally:  # workers live on, and later stages need their memory
            vocab.lattice.forget()
            release()

    return named.mapInArrow(run, schema)


def _written(vocab: Vocabulary, ids: np.ndarray) -> str:
    size = vocab.sizes[ids]
    source = np.arange(size.sum()) + np.repeat(vocab.bounds[ids] - (np.cumsum(size) - size), size)
    return vocab.bytes[source].tobytes().decode("utf-8", "replace")[1:]


def _written_rows(vocab: Vocabulary, ids: np.ndarray, bounds: np.ndarray):
    """The texts that the ids of rows write, as an Arrow column; ``bounds`` are the rows' first ids (rows + 1)."""
    import pyarrow as pa

    size = vocab.sizes[ids]
    ends = np.concatenate([[0], np.cumsum(size)])
    flat = vocab.bytes[np.arange(ends[-1]) + np.repeat(vocab.bounds[ids] - ends[:-1], size)]
    filled = bounds[1:] > bounds[:-1]
    flat = np.delete(flat, ends[bounds[:-1][filled]])  # the space that stands before each text
    offsets = ends[bounds] - np.concatenate([[0], np.cumsum(filled)])
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat))


def decode_ids(segmented: DataFrame, model: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``segmented`` with the text that each row's ids write: pieces joined, bars as spaces, the first one dropped.

    A null array writes an empty text.
    """

    @F.pandas_udf("string")
    def decode(column):
        import pandas as pd

        vocab = vocabulary(model)
        return pd.Series([_written(vocab, np.asarray(row if row is not None else [], np.int64)) for row in column], dtype=object)

    return segmented.withColumn(to, decode(F.col(ids)))
