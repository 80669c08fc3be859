"""M4, M5, M8: gradient boosting of regression trees from histograms merged over tasks.

*Table.*  Features are binned once (quantile cuts for numbers, vocabulary positions for
categories, whose one-hot columns are single positions here) and packed, with key, label,
fold and a hash of the key, into blocks of rows.  Every tree of every model is grown on
that one table.

*A round.*  Before a round, the gradients of all models that grow a tree are written beside the
rows' bins, on local disk; passes read nothing else.  Each level of the current trees is one
pass: tasks send rows to nodes and sum gradients and counts per (model, feature, node, bin);
the sums are shuffled by (model, feature), merged there, and only the best split of each node
leaves for the driver.  So neither rows nor histograms meet the driver, and what it holds grows
with trees, not data.  Of two sister nodes, only the one with fewer rows is summed: the other's
sums are their mother's, kept from the pass before, less those, exactly, as sums are integers.

*Models.*  A run grows any number of models in the same passes: the learners, the fold
fits of each (a row takes no part in the model that holds its fold out) and the candidates
of a search.  Their predictions are the trees' values added up from the bins, where they are needed;
every ``CUT_TREES`` trees they are written with the table.

*Trees.*  ``depth``: every node whose gain is positive is split, level by level.  ``leaf``:
best first up to ``num_leaves``; the levels are evaluated ahead only below nodes that the
best-first order takes, which gives the same tree as growing leaf by leaf.  ``symmetric``: one
split for all nodes of a level.  Leaves have L1 and L2 penalties.

Gradients are summed as integers (fixed point within 53 bits), so sums, and with them trees,
don't depend on how rows are dealt to tasks or on repeated tasks.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.constants import CATEGORICAL_FEATURES, NUMERIC_FEATURES, RANDOM_STATE, TARGET, TUNED_PARAMS
from hearth.operators.encode import fit_vocabulary
from hearth.operators.joins import cut_lineage, drop_table, free_shuffles

# Workers get this module's functions with the task; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 64
#: Rows of a block, few enough that a block with the predictions of some 18 models stays below 1 MB (larger
#: values are allocated apart in the JVM's heap), and blocks of a partition.
BLOCK_ROWS, BLOCKS_A_PARTITION = 1 << 12, 64
#: Rows that a task works on at once: many enough for numpy, few enough for a core's cache.
CHUNK_ROWS = 1 << 17
#: Cells of features that are summed together, and are added up to each one's bins afterwards.
JOINT_CELLS = 1 << 12
#: Levels of a tree whose nodes are told apart by comparing whole columns; below, rows go one by one.
TOP_LEVELS = 6
#: Trees after which the table is written anew with the predictions, so that they aren't added up from the start.
CUT_TREES = 20
#: Categories of a column that may be one-hot; wider ones need an encoding (E2) first.
MAX_CATEGORIES = 1 << 15
#: Fold of rows that no model is trained on.
VALIDATION = -1
_FOUND = np.dtype([("gain", "<f8"), ("bin", "<i4"), ("left_sum", "<f8"), ("left_n", "<i8"), ("total_sum", "<f8"), ("total_n", "<i8")])


# Parameters -------------------------------------------------------------------
@dataclass(frozen=True)
class Params:
    """Settings of one model.  ``min_child_weight`` is a number of rows, as the loss is squared
    error; ``gamma`` is taken off a split's gain; columns are sampled among encoded ones (a
    number or one category)."""

    trees: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    growth: str = "depth"
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    colsample_bylevel: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    num_leaves: int | None = None
    seed: int = RANDOM_STATE


def tuned_learners(trees: int | None = None, max_depth: int | None = None, tuned: dict = TUNED_PARAMS) -> dict[str, Params]:
    """The three tuned learners with all their values; ``trees`` and ``max_depth`` replace the tuned ones."""
    names = {"iterations": "trees", "n_estimators": "trees", "depth": "max_depth", "min_data_in_leaf": "min_child_weight"}
    out = {}
    for learner, source, growth in (("depthwise", "XGBoost", "depth"), ("leafwise", "LightGBM", "leaf"), ("symmetric", "CatBoost", "symmetric")):
        params = Params(growth=growth, **{names.get(k, k): v for k, v in tuned[source].items()})     # a value without a counterpart fails here
        out[learner] = replace(params, trees=trees or params.trees, max_depth=max_depth or params.max_depth)
    return out


# Binning ----------------------------------------------------------------------
@dataclass
class Binner:
    """Numbers: bin = cuts below the value (NULL and NaN: bin 0).  Categories: position in the
    sorted vocabulary, one past its end for unknown ones and NULL."""

    numeric: list[str]
    cuts: list[np.ndarray]
    categorical: list[str]
    values: list[list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def widths(self) -> list[int]:
        return [*(len(c) + 1 for c in self.cuts), *(len(v) + 1 for v in self.values)]

    @property
    def first_category(self) -> int:
        return len(self.numeric)

    def codes(self, columns: Sequence[pa.Array], kind: str) -> np.ndarray:
        """(features, rows) bins of the columns, in the order of ``features``."""
        out = np.empty((len(columns), len(columns[0])), kind)
        for i, column in enumerate(columns):
            if i < len(self.numeric):
                x = pc.fill_null(column.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
                out[i] = np.where(np.isnan(x), 0, np.searchsorted(self.cuts[i], x))
            else:
                known = self.values[i - len(self.numeric)]
                at = pc.index_in(column.cast(pa.string()), value_set=pa.array(known, pa.string()))
                out[i] = pc.fill_null(at, len(known)).to_numpy(zero_copy_only=False)
        return out

    @property
    def kind(self) -> str:
        return "u1" if max(self.widths) <= 256 else "<u2"


def fit_binner(train: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
               max_bins: int = MAX_BINS, accuracy: int = 10_000) -> Binner:
    """Cuts of all numbers from one aggregate of quantile sketches (the cuts are data values; a
    feature with few values gets one bin each), vocabularies by distributed ranks."""
    probs = [i / max_bins for i in range(1, max_bins)]
    row = train.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), probs, accuracy).alias(f"_{i}")
                      for i, c in enumerate(numeric)], *[F.max(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"_m{i}")
                                                         for i, c in enumerate(numeric)]).first()
    # a cut at the largest value would divide nothing
    cuts = [np.array(sorted({v for v in row[f"_{i}"] or () if v < row[f"_m{i}"]})) for i in range(len(numeric))]
    values: list[list[str]] = [[] for _ in categorical]
    if categorical:
        vocabulary = fit_vocabulary(train, categorical)
        wide = vocabulary.groupBy("column").agg(F.count("*").alias("n")).where(F.col("n") > MAX_CATEGORIES).collect()
        if wide:
            raise ValueError(f"too many categories to one-hot, encode them first: {[(r['column'], r['n']) for r in wide]}")
        for r in vocabulary.orderBy("column", "position").collect():                # at most MAX_CATEGORIES a column
            values[list(categorical).index(r["column"])].append(r["value"])
    return Binner(list(numeric), cuts, list(categorical), values)


# Packed table -----------------------------------------------------------------
@dataclass
class Packed:
    """The binned table: ``blocks(keys..., n, codes, label, fold, noise, preds)``, a row for each
    block of rows.  A model's predictions are those in ``preds`` (its base, if that is empty) and the values of
    its trees in ``fitted``, a list of (base, trees)."""

    blocks: DataFrame
    keys: list[str]
    binner: Binner
    fitted: list[tuple[float, list[tuple[np.ndarray, ...]]]] = field(default_factory=list)

    @property
    def models(self) -> int:
        return len(self.fitted)

    def unpacked(self, columns: Callable[[dict, np.ndarray], dict], schema: str) -> DataFrame:
        """A row for each row of the table: keys, fold, label and what ``columns(block, predictions)`` gives."""
        return self._rows(lambda block, of: columns(block, of()), schema)

    def _rows(self, columns: Callable[[dict, Callable], dict], schema: str) -> DataFrame:
        """``unpacked``, but ``columns(block, of)`` calls ``of(models, rows)`` for the predictions that it needs."""
        keys, binner, fitted = self.keys, self.binner, self.fitted

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            predicted = _predictor(fitted, binner.first_category)
            for block in _joined(_blocks(batches), binner, len(fitted)):
                out = {k: block[f"k{i}"] for i, k in enumerate(keys)} | {"fold": block["fold"], "label": block["label"]}
                out |= columns(block, lambda models=None, rows=None: predicted(block, models, rows))
                yield pa.record_batch({k: pa.array(v) for k, v in out.items()})

        head = [f"`{k}` long" for k in keys] + ["fold int", "label double"]
        return self.blocks.drop("noise").mapInArrow(run, ", ".join([*head, schema]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: c[i].as_buffer() if pa.types.is_binary(c.type) else c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}


def _joined(blocks: Iterator[dict], binner: Binner, models: int, most: int = 0) -> Iterator[dict]:
    """Blocks in arrays, as many together as have ``most`` rows; ``sizes`` has the rows of each."""
    kinds, held, n = {"label": "<f8", "fold": "<i4", "noise": "<u8"}, [], 0

    def join() -> dict:
        out = {"n": n, "sizes": [b["n"] for b in held]}
        for name in held[0].keys() - {"n", "preds"}:
            if name == "codes":
                out[name] = np.concatenate([np.frombuffer(b[name], binner.kind).reshape(len(binner.widths), b["n"]) for b in held], axis=1)
            else:
                out[name] = np.concatenate([np.frombuffer(b[name], kinds.get(name, "<i8")) for b in held])
        stored = "preds" in held[0] and len(held[0]["preds"])
        return out | {"preds": np.concatenate([np.frombuffer(b["preds"]).reshape(models, b["n"]) for b in held], axis=1) if stored else None}

    for block in blocks:
        held.append(block)
        n += block["n"]
        if n >= (most or CHUNK_ROWS):
            yield join()
            held, n = [], 0
    if held:
        yield join()


def _predictor(fitted: list[tuple[float, list]], first_category: int) -> Callable:
    """``predicted(block, models, rows)``: predictions of a joined block, a line for each model."""
    tops = [[_Top(arrays, first_category) for arrays in trees] for _, trees in fitted]

    def predicted(block: dict, models: Sequence[int] | None = None, rows: np.ndarray | None = None) -> np.ndarray:
        models = range(len(fitted)) if models is None else models
        codes = block["codes"] if rows is None else np.ascontiguousarray(block["codes"][:, rows])
        out = np.empty((len(models), codes.shape[1]))
        for i, m in enumerate(models):
            out[i] = fitted[m][0] if block["preds"] is None else block["preds"][m] if rows is None else block["preds"][m, rows]
            for top in tops[m]:
                out[i] += top.values(codes)
        return out

    return predicted


def pack(df: DataFrame, binner: Binner, keys: Sequence[str], label: str = TARGET, fold: str | None = "fold") -> Packed:
    """Packs ``df``.  Keys are integers; rows without a label are left out; a NULL fold, like
    ``VALIDATION``, marks rows that no model is trained on, and without a ``fold`` column all rows
    are trained on.  The rows are dealt out evenly by their key once."""
    keys, features, kind = list(keys), binner.features, binner.kind
    rows = df.where(F.col(label).isNotNull()).select(
        *[F.col(k).cast("long").alias(f"k{i}") for i, k in enumerate(keys)], F.col(label).cast("double").alias("label"),
        (F.coalesce(F.col(fold).cast("int"), F.lit(VALIDATION)) if fold else F.lit(0)).alias("fold"),
        F.xxhash64(*[F.col(k).cast("long") for k in keys]).alias("noise"),
        *[F.col(c).cast("double" if i < binner.first_category else "string").alias(f"f{i}") for i, c in enumerate(features)])
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // (BLOCK_ROWS * BLOCKS_A_PARTITION)))
    names = [*(f"k{i}" for i in range(len(keys))), "label", "fold", "noise"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            column = {n: table[n].chunk(0) for n in table.column_names}
            out = {"n": pa.array([table.num_rows], pa.int32()),
                   "codes": binner.codes([column[f"f{i}"] for i in range(len(features))], kind).tobytes(), "preds": b""}
            out |= {n: column[n].to_numpy(zero_copy_only=False).tobytes() for n in names}
            return pa.record_batch({n: v if n == "n" else pa.array([v], pa.binary()) for n, v in out.items()})

        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                held.append(batch.slice(lo, BLOCK_ROWS - sum(b.num_rows for b in held)))
                lo += held[-1].num_rows
                if sum(b.num_rows for b in held) == BLOCK_ROWS:
                    yield block()
                    held = []
        if held:
            yield block()

    schema = "n int, codes binary, preds binary" + "".join(f", {n} binary" for n in names)
    return Packed(cut_lineage(rows.repartition(parts, "noise").mapInArrow(run, schema)), keys, binner)


# Trees ------------------------------------------------------------------------
@dataclass
class Tree:
    """Nodes of one tree; ``feature`` is -1 for leaves, ``right`` follows ``left``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, gain: float) -> int:
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, bin_, len(self.feature), gain
        for _ in range(2):
            for column, v in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.value, 0.0), (self.rows, 0), (self.gain, 0.0)):
                column.append(v)
        return self.left[node]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.value)


class _Top:
    """A tree with its upper levels laid out by place: the children of place p are at 2 p and 2 p + 1, and
    a leaf's rows move on along 2 p."""

    def __init__(self, arrays: tuple[np.ndarray, ...], first_category: int) -> None:
        feature, bins, left, value = arrays
        self.arrays, self.first_category = arrays, first_category
        self.levels: list[dict[tuple[int, int, bool], list[int]]] = []     # the places that a split divides; [] for all
        self.ids = np.zeros(1, np.int64)                        # the node at each place
        while len(self.levels) < TOP_LEVELS and (feature[self.ids] >= 0).any():
            inner = np.flatnonzero(feature[self.ids] >= 0)
            nodes = self.ids[inner]
            level: dict[tuple[int, int, bool], list[int]] = {}
            for p, v in zip(inner.tolist(), nodes.tolist()):
                level.setdefault((int(feature[v]), int(bins[v]), bool(feature[v] >= first_category)), []).append(p)
            self.levels.append({split: [] if len(places) == len(self.ids) else places for split, places in level.items()})
            self.ids = np.repeat(self.ids, 2)
            self.ids[2 * inner], self.ids[2 * inner + 1] = left[nodes], left[nodes] + 1
        self.whole = not (feature[self.ids] >= 0).any()         # all leaves are at a place
        self.by_place = value[self.ids]

    def places(self, codes: np.ndarray) -> np.ndarray:
        place = np.zeros(codes.shape[1], np.uint8)
        for level in self.levels:
            right = None
            for (f, b, category), places in level.items():
                test = codes[f] == b if category else codes[f] > b
                if places:
                    own = place == places[0]
                    for p in places[1:]:
                        own |= place == p
                    test &= own
                right = test if right is None else np.logical_or(right, test, out=right)
            place <<= 1
            place |= right.view(np.uint8)
        return place

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row (column of ``codes``)."""
        feature, bins, left, _ = self.arrays
        node = self.ids.take(self.places(codes).astype(np.intp))
        rows = np.arange(0 if self.whole else len(node))
        while len(rows):
            at = node[rows]
            f = feature[at]
            open_ = f >= 0
            rows, at, f = rows[open_], at[open_], f[open_]
            code, b = codes[f, rows], bins[at]
            node[rows] = left[at] + np.where(f >= self.first_category, code == b, code > b)
        return node

    def values(self, codes: np.ndarray) -> np.ndarray:
        if self.whole:
            return self.by_place.take(self.places(codes).astype(np.intp))
        return self.arrays[3].take(self.nodes(codes))


# One pass ---------------------------------------------------------------------
@dataclass
class _Grown:
    """What a model needs in a pass: its tree so far, the number of each node that is summed, and how the open
    nodes' sums are made: those of a node of the last pass (-1: none) plus ``sign`` times those of a
    node of this one (-1: none)."""

    arrays: tuple[np.ndarray, ...]
    slot: np.ndarray
    slots: int
    before: np.ndarray
    now: np.ndarray
    sign: np.ndarray


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(noise: np.ndarray, share: float, mark: int) -> np.ndarray:
    """Which rows a tree is grown on: by the row's hash and the tree, so the same in each pass."""
    return _mix(noise + np.uint64(mark)) < np.uint64(min(int(share * 2.0**64), 2**64 - 1))


#: Gradients of rows that a model's tree isn't grown on.
_UNUSED = {"<i4": -(1 << 31), "<i8": -(1 << 63)}


def _gradients(table: RDD, packed: Packed, live: dict[int, tuple[int | None, float, int]], scale: float) -> RDD:
    """``(n, codes, kind, gradients)`` of each block: integer gradients, a line for each model of ``live``, which gives
    the fold that a model holds out, the share of rows of this tree and the mark by which they are drawn."""
    binner, fitted = packed.binner, packed.fitted

    def run(blocks: Iterator[dict]) -> Iterator[tuple]:
        predicted = _predictor(fitted, binner.first_category)
        for block in _joined(blocks, binner, len(fitted)):
            exact = predicted(block, list(live))
            exact -= block["label"]
            exact *= scale
            np.rint(exact, out=exact)
            kind = "<i4" if max(exact.max(), -exact.min()) < 1 << 31 else "<i8"
            out = exact.astype(kind)
            unused: dict[tuple, np.ndarray] = {}
            for line, (held_out, share, mark) in zip(out, live.values()):
                if (held_out, share, mark) not in unused:
                    none = (block["fold"] == VALIDATION) | (block["fold"] == (VALIDATION if held_out is None else held_out))
                    unused[held_out, share, mark] = none | ~drawn(block["noise"], share, mark) if share < 1 else none
                np.putmask(line, unused[held_out, share, mark], _UNUSED[kind])
            a = 0
            for n in block["sizes"]:
                yield n, block["codes"][:, a:a + n].tobytes(), kind, out[:, a:a + n].tobytes()
                a += n

    return table.mapPartitions(run)


def _groups(widths: Sequence[int], most: int) -> list[list[int]]:
    """Features to be summed together, so that the cells of a group are at most ``most`` (or one feature's)."""
    groups: list[list[int]] = []
    for f in sorted(range(len(widths)), key=lambda f: (-widths[f], f)):
        own = next((g for g in groups if math.prod(widths[i] for i in g) * widths[f] <= most), None)
        if own is None:
            groups.append(own := [])
        own.append(f)
    return groups


class _Sums:
    """The sums of one task: (slot, bin) tables of gradients and rows for each model and feature."""

    def __init__(self, grown: dict[int, _Grown], order: Sequence[int], widths: list[int], first_category: int) -> None:
        self.grown, self.order, self.widths = grown, order, widths
        self.starts = np.concatenate([[0], np.cumsum(widths)]).tolist()
        shape = {m: (g.slots, self.starts[-1]) for m, g in grown.items()}
        self.sums = {m: np.zeros(x, np.int64) for m, x in shape.items()}
        self.counts = {m: np.zeros(x, np.int64) for m, x in shape.items()}
        self.tops = {m: _Top(g.arrays, first_category) for m, g in grown.items()}

    def add(self, codes: np.ndarray, gradients: np.ndarray, use: np.ndarray) -> None:
        """A chunk of rows; ``gradients`` is 0 where ``use`` isn't true."""
        joint: dict[int, list] = {}
        whole: dict[int, list] = {}
        for line, m in enumerate(self.order):
            g = self.grown.get(m)
            if g is None or not g.slots:
                continue
            most = 1 << max(min(JOINT_CELLS, codes.shape[1] // g.slots), 1).bit_length() - 1
            at, slot = self._rows(m, codes, use[line])
            if most not in joint:
                joint[most] = [(group, self._code(codes, group)) for group in _groups(self.widths, most)]
            if at is None and most not in whole:
                whole[most] = [(group, code.astype(np.intp)) for group, code in joint[most]]
            self._add(m, joint[most] if at is not None else whole[most], gradients[line], use[line], at, slot)

    def _code(self, codes: np.ndarray, group: list[int]) -> np.ndarray:
        code = codes[group[0]].astype(np.uint16)
        for f in group[1:]:
            code = code * np.uint16(self.widths[f]) + codes[f]
        return code

    def _rows(self, m: int, codes: np.ndarray, use: np.ndarray) -> tuple[np.ndarray | None, np.ndarray | None]:
        """The rows of the summed nodes and their slots; None for all rows in slot 0."""
        g, top = self.grown[m], self.tops[m]
        if not top.levels:
            return None, None
        if not top.whole or g.slots > 32:
            slot = g.slot.take(top.nodes(codes))
            at = np.flatnonzero(use & (slot >= 0))
            return at, slot.take(at)
        place, by_place = top.places(codes), g.slot[top.ids]
        own, seen = np.zeros(len(place), bool), set()
        for p in np.flatnonzero(by_place >= 0).tolist():
            if (node := top.ids[p]) not in seen:               # the first place is the one that rows come to
                seen.add(node)
                own |= place == p
        at = np.flatnonzero(own & use)
        return at, by_place.take(place.take(at).astype(np.intp))

    def _add(self, m: int, joint: list, gradient: np.ndarray, use: np.ndarray, at: np.ndarray | None, slot: np.ndarray | None) -> None:
        n, slots = len(gradient) if at is None else len(at), self.grown[m].slots
        if not n:
            return
        # a row's gradient and 1 << bits go into one integer, so that both are summed at once
        bits = (max(int(gradient.max()), -int(gradient.min())) * n).bit_length() + 1
        if bits + n.bit_length() > 62 and n > 1:
            for half in (slice(None, n // 2), slice(n // 2, None)):
                if at is None:
                    self._add(m, [(group, code[half]) for group, code in joint], gradient[half], use[half], None, None)
                else:
                    self._add(m, joint, gradient, use, at[half], slot[half])
            return
        bits = min(bits, 61)                                    # for one row, whose gradient has 53 bits at most
        value = (gradient + (1 << bits)) * use if at is None else gradient.take(at) + (1 << bits)
        stride = max(math.prod(self.widths[f] for f in group) for group, _ in joint)
        start = None if at is None else slot * stride
        for group, code in joint:
            wide = [self.widths[f] for f in group]
            table = np.zeros(slots * stride, np.int64)
            np.add.at(table, code if at is None else code.take(at) + start, value)
            table = table.reshape(slots, stride)[:, :math.prod(wide)].reshape(slots, *wide)
            for i, f in enumerate(group):
                both = table.sum(axis=tuple(1 + j for j in range(len(group)) if j != i))
                rows = (both + (1 << bits - 1)) >> bits
                a, b = self.starts[f], self.starts[f + 1]
                self.counts[m][:, a:b] += rows
                self.sums[m][:, a:b] += both - (rows << bits)

    def found(self) -> Iterator[tuple]:
        for m, g in self.grown.items():
            if self.counts[m].any():
                for f, (a, b) in enumerate(zip(self.starts[:-1], self.starts[1:])):
                    yield (m, f), (True, self.sums[m][:, a:b].tobytes(), self.counts[m][:, a:b].tobytes())


def soft(total: np.ndarray, alpha: float) -> np.ndarray:
    """The gradient sum after the L1 penalty."""
    return np.sign(total) * np.maximum(np.abs(total) - alpha, 0)


def score(total: np.ndarray, n: np.ndarray, p: Params) -> np.ndarray:
    """Twice what a leaf with these sums takes off the objective."""
    return soft(total, p.reg_alpha) ** 2 / np.maximum(n + p.reg_lambda, 1e-300)


def best_split(sums: np.ndarray, counts: np.ndarray, allowed: np.ndarray, category: bool, p: Params) -> np.ndarray:
    """The best split of each node (or of all together, for symmetric trees) by one feature, from (node,
    bin) sums.  Numbers go left up to a bin, categories go right if they are the bin; ``allowed``
    says which bins may split.  The lower bin wins ties."""
    total, n = sums.sum(axis=1), counts.sum(axis=1)
    if category:
        left, left_n = total[:, None] - sums, n[:, None] - counts
    else:
        left, left_n = np.cumsum(sums, axis=1), np.cumsum(counts, axis=1)
    right, right_n = total[:, None] - left, n[:, None] - left_n
    gain = (score(left, left_n, p) + score(right, right_n, p) - score(total, n, p)[:, None]) / 2
    least = max(p.min_child_weight, 1)
    fits = (left_n >= least) & (right_n >= least)
    if p.growth == "symmetric":
        shared = np.where(allowed & fits.any(axis=0), np.where(fits, gain, 0).sum(axis=0) - p.gamma, -np.inf)
        at = np.full(len(total), int(np.argmax(shared)))
        best = np.full(len(total), shared[at[0]])
    else:
        gain = np.where(fits & allowed, gain - p.gamma, -np.inf)
        at = np.argmax(gain, axis=1)
        best = gain[np.arange(len(total)), at]
    nodes, found = np.arange(len(total)), np.empty(len(total), _FOUND)
    for name, v in (("gain", best), ("bin", at), ("left_sum", left[nodes, at]), ("left_n", left_n[nodes, at]), ("total_sum", total), ("total_n", n)):
        found[name] = v
    return found


def level_splits(rows: RDD, order: Sequence[int], binner: Binner, grown: dict[int, _Grown], params: dict[int, Params],
                 allowed: dict[int, np.ndarray], scale: float, last: RDD | None = None) -> tuple[dict[int, dict[int, np.ndarray]], RDD]:
    """One pass over the gradients of the models in ``order``: model -> feature -> the best split of each open node by it
    (the same one for all nodes of symmetric trees); and the open nodes' sums, which the next pass takes as ``last``."""
    widths, kind, first = binner.widths, binner.kind, binner.first_category
    starts, lines = np.concatenate([[0], np.cumsum(widths)]), len(order)

    def partial(blocks: Iterator[tuple]) -> Iterator[tuple]:
        sums = _Sums(grown, order, widths, first)
        held: list[tuple] = []

        def add() -> None:
            n = sum(b[0] for b in held)
            codes, gradients, use = np.empty((len(widths), n), kind), np.empty((lines, n), np.int64), np.empty((lines, n), bool)
            a = 0
            for size, own, own_kind, line in held:
                codes[:, a:a + size] = np.frombuffer(own, kind).reshape(len(widths), size)
                gradients[:, a:a + size] = line = np.frombuffer(line, own_kind).reshape(lines, size)
                np.not_equal(line, _UNUSED[own_kind], out=use[:, a:a + size])
                a += size
            gradients *= use
            sums.add(codes, gradients, use)

        for block in blocks:
            held.append(block)
            if sum(b[0] for b in held) >= CHUNK_ROWS:
                add()
                held = []
        if held:
            add()
        return sums.found()

    def merged(records: Iterator[tuple]) -> Iterator[tuple]:
        tables: dict[tuple, list] = {}
        for key, (own, sums, counts) in records:                # added up as they come: one from each task, and the last pass's
            slots = tables.setdefault(key, [None, None])
            both = np.stack([np.frombuffer(sums, "<i8"), np.frombuffer(counts, "<i8")]).reshape(2, -1, widths[key[1]])
            slots[own] = both if slots[own] is None else slots[own] + both
        for (m, f), (was, now) in tables.items():
            g, none = grown[m], np.zeros((2, 1, widths[f]), np.int64)
            # index -1 is the added line of zeros
            was, now = (none if x is None else np.concatenate([x, none], axis=1) for x in (was, now))
            sums, counts = was[:, g.before] + now[:, g.now] * g.sign[:, None]
            found = best_split(sums / scale, counts, allowed[m][starts[f]:starts[f + 1]], f >= first, params[m])
            yield (m, f), (False, sums.tobytes(), counts.tobytes()), found.tobytes()

    records = rows.mapPartitions(partial)
    if last is not None:
        records = records.union(last.filter(lambda r: r[0][0] in grown).map(lambda r: (r[0], r[1])))
    parts = min(rows.context.defaultParallelism, len(grown) * len(widths))
    sums = records.partitionBy(parts, lambda key: key[0] * len(widths) + key[1]).mapPartitions(merged).persist(StorageLevel.DISK_ONLY)
    out: dict[int, dict[int, np.ndarray]] = {}
    for (m, f), found in sums.map(lambda r: (r[0], r[2])).collect():
        out.setdefault(m, {})[f] = np.frombuffer(found, _FOUND)
    return out, sums


# Growing ----------------------------------------------------------------------
@dataclass
class Model:
    """One model of a run: its settings, the fold it holds out, and its trees."""

    name: str
    params: Params
    held_out: int | None = None
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    stopped: bool = False


class _Growing:
    """The tree that a model grows at present."""

    def __init__(self, model: Model, number: int, index: int, units: np.ndarray) -> None:
        p = model.params
        self.params, self.units, self.tree, self.index = p, units, Tree(), number
        self.rng = np.random.default_rng([p.seed, index, number])
        every = max(int(units.max()) + 1, 1)
        self.columns = self._sample(np.arange(every), p.colsample_bytree)
        self.open, self.depth, self.done = [0], {0: 0}, p.max_depth < 1
        self.sums: dict[int, tuple[float, int]] = {}
        self.last: list[int] = []                               # the nodes of the last pass
        self.family: dict[int, tuple[int, int]] = {}            # node -> its mother and sister
        self.known: dict[int, tuple] = {}                       # leaf-wise: node -> (gain, feature, bin, left sums)
        self.children: dict[int, int] = {}                      # and the first of its two children, once it was taken

    def _sample(self, columns: np.ndarray, share: float) -> np.ndarray:
        return columns if share >= 1 else np.sort(self.rng.choice(columns, max(1, round(share * len(columns))), replace=False))

    def allowed(self) -> np.ndarray:
        """Which bins of all features may split at this level."""
        columns = np.zeros(max(int(self.units.max()) + 1, 1), bool)
        columns[self._sample(self.columns, self.params.colsample_bylevel)] = True
        return (self.units >= 0) & columns[self.units]

    def grown(self) -> _Grown:
        """Of two sisters the one with fewer rows is summed, and the other one is what is left of their mother."""
        last, open_, summed = {node: i for i, node in enumerate(self.last)}, set(self.open), {}
        before, now, sign = (np.full(len(self.open), x) for x in (-1, -1, 1))
        for i, node in enumerate(self.open):
            mother, sister = self.family.get(node, (-1, -1))
            if node in last:                                    # whole since the last pass
                before[i] = last[node]
            elif mother in last and sister in open_ and (self.sums[sister][1], sister) < (self.sums[node][1], node):
                before[i], sign[i] = last[mother], -1
                now[i] = summed.setdefault(sister, len(summed))
            else:
                now[i] = summed.setdefault(node, len(summed))
        slot = np.full(len(self.tree.feature), -1)
        slot[list(summed)] = list(summed.values())
        return _Grown(self.tree.arrays(), slot, len(summed), before, now, sign)

    def _divide(self, node: int, gain: float, feature: int, bin_: int, left: tuple[float, int]) -> tuple[int, int]:
        total = self.sums[node]
        child = self.tree.split(node, feature, bin_, gain)
        self.sums[child], self.sums[child + 1] = left, (total[0] - left[0], total[1] - left[1])
        self.depth[child] = self.depth[child + 1] = self.depth[node] + 1
        self.family |= {child: (node, child + 1), child + 1: (node, child)}
        return child, child + 1

    def take(self, rows: dict[int, np.ndarray]) -> None:
        """The best splits of the open nodes by each feature; the first feature wins ties."""
        if not rows:
            self.done = True
            return
        self.last, features = self.open, sorted(rows)
        table = np.stack([rows[f] for f in features])
        best = np.argmax(table["gain"], axis=0)
        found = {}
        for i, node in enumerate(self.open):
            r = table[best[i], i]
            self.sums.setdefault(node, (float(r["total_sum"]), int(r["total_n"])))
            found[node] = float(r["gain"]), features[best[i]], int(r["bin"]), (float(r["left_sum"]), int(r["left_n"]))
        level = self.depth[self.open[0]] + 1
        if self.params.growth == "leaf":
            self.known |= found
            self.open = self._best_first()
        else:
            opened: list[int] = []
            for node, (gain, feature, bin_, left) in found.items():
                if gain > 0 and self.params.growth == "symmetric":
                    least, total = max(self.params.min_child_weight, 1), self.sums[node][1]
                    if least <= left[1] <= total - least:
                        opened += self._divide(node, gain / len(found), feature, bin_, left)
                    else:                                       # too few rows on a side: the node stays whole at this level
                        opened.append(node)
                        self.depth[node] = level
                elif gain > 0:
                    opened += self._divide(node, gain, feature, bin_, left)
            self.open = opened if level < self.params.max_depth else []
        self.done = not self.open

    def _best_first(self) -> list[int]:
        """Rebuilds the tree from the nodes known so far, best gain first, and gives the nodes
        still to be evaluated below them.  A node left out now stays left out: what becomes
        known later only adds rivals."""
        p, heap, chosen, open_ = self.params, [(-self.known[0][0], 0)], set(), []
        while heap and len(chosen) < (p.num_leaves or 1 << 60) - 1:
            gain, node = heapq.heappop(heap)
            if gain >= 0:
                break
            chosen.add(node)
            if node not in self.children:
                total, left, a = self.sums[node], self.known[node][3], 1 + 2 * len(self.children)
                self.children[node] = a
                self.sums[a], self.sums[a + 1] = left, (total[0] - left[0], total[1] - left[1])
                self.depth[a] = self.depth[a + 1] = self.depth[node] + 1
                self.family |= {a: (node, a + 1), a + 1: (node, a)}
            for child in (self.children[node], self.children[node] + 1):
                if child in self.known:
                    heapq.heappush(heap, (-self.known[child][0], child))
                elif self.depth[child] < p.max_depth:
                    open_.append(child)
        self.tree = Tree()
        for node in self.children:                              # in order of their numbers, which stay the same from pass to pass
            gain, feature, bin_, _ = self.known[node]
            self.tree.split(node, feature if node in chosen else -1, bin_, gain)
        return open_

    def finish(self) -> Tree:
        p = self.params
        for node in range(len(self.tree.feature)):
            total, n = self.sums.get(node, (0.0, 0))
            self.tree.rows[node] = int(n)
            if self.tree.feature[node] < 0 and n:
                self.tree.value[node] = float(-p.learning_rate * soft(np.float64(total), p.reg_alpha) / (n + p.reg_lambda))
        return self.tree


def _units(binner: Binner) -> np.ndarray:
    """The encoded column of each bin of each feature, -1 for bins that split nothing: the last one
    of a number, and of a category the first position (the dropped one) and the unknown ones."""
    out, unit = [], 0
    for i, w in enumerate(binner.widths):
        if i < binner.first_category:
            out += [unit] * (w - 1) + [-1]
            unit += 1
        else:
            out += [-1] + [unit + j for j in range(w - 2)] + [-1] * (w > 1)
            unit += max(w - 2, 0)
    return np.array(out)


def _with_predictions(packed: Packed) -> DataFrame:
    """The blocks with all predictions written in them."""
    binner, fitted, names = packed.binner, packed.fitted, packed.blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predicted = _predictor(fitted, binner.first_category)
        for batch in batches:
            for i, block in enumerate(_joined(_blocks([batch]), binner, len(fitted), 1)):
                preds = pa.array([predicted(block).tobytes()], pa.binary())
                yield pa.record_batch({n: preds if n == "preds" else batch.column(n).slice(i, 1) for n in names})

    return packed.blocks.mapInArrow(run, packed.blocks.schema)


def errors(packed: Packed) -> DataFrame:
    """``model, n, abs_sum, sq_sum`` of each model over the validation rows."""
    binner, fitted, models = packed.binner, packed.fitted, packed.models

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, predicted = np.zeros((models, 3)), _predictor(fitted, binner.first_category)
        for block in _joined(_blocks(batches), binner, models):
            own = np.flatnonzero(block["fold"] == VALIDATION)
            e = predicted(block, None, own) - block["label"][own]
            total += np.stack([np.full(models, len(own)), np.abs(e).sum(axis=1), (e * e).sum(axis=1)], axis=1)
        yield pa.record_batch({"model": pa.array(range(models), pa.int32()), "n": pa.array(total[:, 0].astype(np.int64)),
                               "abs_sum": pa.array(total[:, 1]), "sq_sum": pa.array(total[:, 2])})

    parts = packed.blocks.select("n", "codes", "label", "fold", "preds").mapInArrow(run, "model int, n long, abs_sum double, sq_sum double")
    return parts.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("n", "abs_sum", "sq_sum")])


def _start(packed: Packed, models: list[Model]) -> float:
    """Sets each model's base to the mean label of its rows; gives the scale of integer gradients."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            fold, label = np.frombuffer(block["fold"], "<i4"), np.frombuffer(block["label"])
            keys, at = np.unique(fold, return_inverse=True)
            yield pa.record_batch({"fold": pa.array(keys), "n": pa.array(np.bincount(at)), "total": pa.array(np.bincount(at, label)),
                                   "least": pa.array([label[at == i].min() for i in range(len(keys))]),
                                   "most": pa.array([label[at == i].max() for i in range(len(keys))])})

    rows = (packed.blocks.select("n", "label", "fold").mapInArrow(run, "fold int, n long, total double, least double, most double").groupBy("fold")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))
            .where(F.col("fold") != VALIDATION).collect())
    for m in models:
        own = [r for r in rows if r["fold"] != m.held_out]
        n = sum(r["n"] for r in own)
        # rounded, as the order of summation may change the last bits from run to run
        m.base = float(f"{sum(r['total'] for r in own) / n:.9g}") if n else 0.0
    reach = max((max(r["most"] - m.base, m.base - r["least"]) for r in rows for m in models), default=0.0)
    n = sum(r["n"] for r in rows)
    return 2.0 ** math.floor(50 - math.log2(n * reach)) if n * reach > 1e-200 else 1.0


def grow(packed: Packed, models: list[Model], after_tree: Callable[[int, dict[int, tuple[int, float, float]]], set[int]] | None = None,
         check: Sequence[int] = ()) -> Packed:
    """Grows all trees of ``models`` (whose ``trees`` are filled) and gives the table with their
    predictions.  After each number of trees in ``check``, ``after_tree(trees, {model: (rows, sum of absolute
    errors, sum of squared errors)})`` sees the errors on the validation rows and names the models that stop.

    Models that are done no longer cost anything in a pass.  A run keeps two tables on local disk,
    rebuilt from the last written one if an executor is lost: bins, labels and folds, and for the trees that grow at
    present bins and gradients.  They are read block by block, so an executor's memory holds none of
    them, however many rows and models there are."""
    scale, units = _start(packed, models), _units(packed.binner)
    state, written = _based(packed, models), None
    table = _table(state).persist(StorageLevel.DISK_ONLY)
    for number in range(max((m.params.trees for m in models), default=0)):
        live = {i: _Growing(m, number, i, units) for i, m in enumerate(models) if number < m.params.trees and not m.stopped}
        if not live:
            break
        if number and number % CUT_TREES == 0:
            now = cut_lineage(_with_predictions(state))
            state = replace(state, blocks=now, fitted=[(m.base, []) for m in models])
            table.unpersist()
            table = _table(state).persist(StorageLevel.DISK_ONLY)
            if written is not None:
                drop_table(written)
            written = now
        draws = {i: (models[i].held_out, g.params.subsample, (g.params.seed * 1_000_003 + number) * 0x9E3779B97F4A7C15 % (1 << 64))
                 for i, g in live.items()}
        rows, sums = _gradients(table, state, draws, scale).persist(StorageLevel.DISK_ONLY), None
        while open_ := {i: g for i, g in live.items() if not g.done}:
            last = sums
            found, sums = level_splits(rows, list(live), state.binner, {i: g.grown() for i, g in open_.items()}, {i: g.params for i, g in open_.items()},
                                       {i: g.allowed() for i, g in open_.items()}, scale, last)
            for i, g in open_.items():
                g.take(found.get(i, {}))
            if last is not None:
                last.unpersist()
        if sums is not None:
            sums.unpersist()
        rows.unpersist()
        free_shuffles(packed.blocks.sparkSession)
        for i, g in live.items():
            models[i].trees.append(g.finish())
        state = replace(state, fitted=[(base, [*trees, models[i].trees[-1].arrays()] if i in live else trees) for i, (base, trees) in enumerate(state.fitted)])
        if number + 1 in check and after_tree:
            found = {r["model"]: (r["n"], r["abs_sum"], r["sq_sum"]) for r in errors(state).collect()}
            for i in after_tree(number + 1, found):
                models[i].stopped = True
    table.unpersist()
    return state


def _based(packed: Packed, models: list[Model]) -> Packed:
    """The table with the models' bases as their predictions."""
    return replace(packed, blocks=packed.blocks.withColumn("preds", F.lit(b"")), fitted=[(m.base, []) for m in models])


def _table(packed: Packed) -> RDD:
    """The blocks without their keys, a dict each."""
    return packed.blocks.select("n", "codes", "label", "fold", "noise", "preds").rdd.map(lambda r: {k: v if k == "n" else bytes(v) for k, v in r.asDict().items()})


def root_splits(packed: Packed, models: list[Model]) -> DataFrame:
    """``held_out, feature, split_at, gain, left_rows, right_rows``: each model's best first split by each
    feature, if one is allowed (a row for each model and feature, from one pass)."""
    scale, spark, b = _start(packed, models), packed.blocks.sparkSession, packed.binner
    state, one = _based(packed, models), np.zeros(1, np.int64)
    gradients = _gradients(_table(state), state, {i: (m.held_out, 1.0, 0) for i, m in enumerate(models)}, scale)
    grown = {i: _Grown(Tree().arrays(), one, 1, one - 1, one, one + 1) for i in range(len(models))}
    found, sums = level_splits(gradients, list(grown), b, grown, {i: m.params for i, m in enumerate(models)}, {i: _units(b) >= 0 for i in grown}, scale)
    sums.unpersist()
    rows = []
    for i, by_feature in found.items():
        for f, (best,) in by_feature.items():
            if np.isfinite(best["gain"]):
                at = repr(float(b.cuts[f][best["bin"]])) if f < b.first_category else b.values[f - b.first_category][best["bin"]]
                rows.append((models[i].held_out, b.features[f], at, float(best["gain"]), int(best["left_n"]), int(best["total_n"] - best["left_n"])))
    return spark.createDataFrame(rows, "held_out INT, feature STRING, split_at STRING, gain DOUBLE, left_rows LONG, right_rows LONG")


# Scoring ----------------------------------------------------------------------
@dataclass
class Boosted:
    """Fitted models over one binner, for rows that were not in the table."""

    binner: Binner
    models: list[Model]

    def predict(self, df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
        """``df`` with a prediction column for each model (``names``: model -> column)."""
        shared = df.sparkSession.sparkContext.broadcast((self.binner, [(m.base, [t.arrays() for t in m.trees]) for m in self.models]))

        @F.pandas_udf("array<double>")
        def run(rows: pd.DataFrame) -> pd.Series:
            binner, fitted = shared.value
            if not len(rows):
                return pd.Series([], dtype=object)
            kinds = [pa.float64()] * len(binner.numeric) + [pa.string()] * len(binner.categorical)
            columns = [pa.array(rows[f"f{i}"], k, from_pandas=True) for i, k in enumerate(kinds)]
            codes = binner.codes(columns, binner.kind)
            out = np.empty((len(rows), len(fitted)))
            for j, (base, trees) in enumerate(fitted):
                total = np.full(len(rows), base)
                for arrays in trees:
                    total += _Top(arrays, binner.first_category).values(codes)
                out[:, j] = total
            return pd.Series(list(out))

        kinds = ["double"] * len(self.binner.numeric) + ["string"] * len(self.binner.categorical)
        inputs = F.struct(*[F.col(c).cast(k).alias(f"f{i}") for i, (c, k) in enumerate(zip(self.binner.features, kinds))])
        out = df.withColumn("_preds", run(inputs))
        names = names or {m.name: f"pred_{m.name}" for m in self.models}
        return out.withColumns({names[m.name]: F.col("_preds")[j] for j, m in enumerate(self.models)}).drop("_preds")

    def to_json(self) -> str:
        """Cuts, vocabularies, settings and trees as one document."""
        b = self.binner
        return json.dumps({"numeric": b.numeric, "cuts": [c.tolist() for c in b.cuts], "categorical": b.categorical, "values": b.values,
                           "models": [{"name": m.name, "params": asdict(m.params), "base": m.base, "trees": [asdict(t) for t in m.trees]}
                                      for m in self.models]})

    @classmethod
    def from_json(cls, text: str) -> Boosted:
        d = json.loads(text)
        return cls(Binner(d["numeric"], [np.array(c) for c in d["cuts"]], d["categorical"], d["values"]),
                   [Model(m["name"], Params(**m["params"]), None, m["base"], [Tree(**t) for t in m["trees"]]) for m in d["models"]])

    def importances(self, spark: SparkSession) -> DataFrame:
        """``model, feature, splits, gain``: how often and how well each feature splits."""
        rows = {(m.name, f): [0, 0.0] for m in self.models for f in self.binner.features}
        for m in self.models:
            for t in m.trees:
                for f, g in zip(t.feature, t.gain):
                    if f >= 0:
                        own = rows[m.name, self.binner.features[f]]
                        own[0], own[1] = own[0] + 1, own[1] + g
        return spark.createDataFrame([(*k, *v) for k, v in rows.items()], "model STRING, feature STRING, splits INT, gain DOUBLE")


def fit(df: DataFrame, learners: dict[str, Params], keys: Sequence[str], label: str = TARGET, fold: str | None = None,
        folds: Sequence[int] = (), binner: Binner | None = None, **bins) -> tuple[Boosted, Packed, list[Model]]:
    """Fits ``learners`` on all of ``df`` whose fold isn't ``VALIDATION`` and, with ``folds``, each once
    more for each fold held out, all in the same passes.  Gives the full models, the table with
    all predictions and the list of all models in the order of its predictions."""
    binner = binner or fit_binner(df if fold is None else df.where(F.col(fold) != VALIDATION), **bins)
    return fit_packed(pack(df, binner, keys, label, fold), learners, folds)


def fit_packed(packed: Packed, learners: dict[str, Params], folds: Sequence[int] = ()) -> tuple[Boosted, Packed, list[Model]]:
    """``fit`` on a packed table."""
    models = [Model(n, p) for n, p in learners.items()] + [Model(n, p, k) for n, p in learners.items() for k in folds]
    done = grow(packed, models)
    return Boosted(packed.binner, models[:len(learners)]), done, models


def out_of_fold(done: Packed, models: list[Model], names: dict[str, str]) -> DataFrame:
    """M5: keys, ``fold, label`` and each learner's prediction by the model that held the row's fold out."""
    at = {n: {m.held_out: i for i, m in enumerate(models) if m.name == n} for n in names}

    def columns(block: dict, of: Callable) -> dict:
        out = {column: np.empty(block["n"]) for column in names.values()}
        for f in np.unique(block["fold"]).tolist():
            rows = np.flatnonzero(block["fold"] == f)
            for column, preds in zip(out, of([at[n].get(f, at[n].get(None, 0)) for n in names], rows)):
                out[column][rows] = preds
        return out

    return done._rows(columns, ", ".join(f"`{c}` double" for c in names.values())).where(F.col("fold") != VALIDATION)


# M8 ---------------------------------------------------------------------------
def halving_search(packed: Packed, candidates: dict[str, Params], rungs: Sequence[int], keep: float = 0.5) -> list[dict]:
    """Grows all candidates together on one binned table.  After each number of trees in ``rungs`` the
    better ``keep`` of the live ones by validation MAE (the first named wins ties) go on; the rest stop.  Gives, in
    order of names, ``name, trees, val_mae, rank``: candidates that went further rank before the others."""
    names = list(candidates)
    models = [Model(n, p) for n, p in candidates.items()]
    live = set(range(len(models)))
    seen: dict[int, tuple[int, float]] = {}

    def after(trees: int, found: dict[int, tuple[int, float, float]]) -> set[int]:
        for i in live:
            n, total, _ = found[i]
            seen[i] = (trees, total / n if n else math.inf)
        ranked = sorted(live, key=lambda i: (seen[i][1], i))
        out = set(ranked[max(1, math.ceil(keep * len(ranked))):])
        live.difference_update(out)
        return out

    last = max(p.trees for p in candidates.values())
    grow(packed, models, after, sorted({*(r for r in rungs if r < last), last}))
    ranked = sorted(range(len(models)), key=lambda i: (-seen[i][0], seen[i][1], i))
    return [{"name": names[i], "trees": seen[i][0], "val_mae": seen[i][1], "rank": ranked.index(i) + 1} for i in range(len(models))]
