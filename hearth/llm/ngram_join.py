"""Operator 10: exact Jaccard self-join of texts on word n-grams by vertical partitioning.

The global order of n-grams is that of their 64-bit names.  It is cut into fragments:

1. *First fragment, all texts.*  Each text sends the n-grams of the first fragment
   (0.4 of the order).  A count of those that another text shares, too, bounds its
   overlap with any other: a text may lack at most a quarter of its set, so most texts
   leave the join here.  Tasks pre-aggregate: an n-gram that several texts of a batch
   share is sent once for all of them.
2. *All fragments, remaining texts.*  The same count over their whole sets.
3. *Blocks.*  Remaining n-grams are ordered by frequency; linked texts share one of the
   rarest quarter (prefix filter).  The texts of each such n-gram meet in the block of
   the smallest of them, so every link lies inside a block.  A block counts partial
   overlaps fragment by fragment and sums them per pair; texts that the block's hub
   already joins aren't compared with each other.  A block above ``block_bytes`` is dealt
   into chunks that share its hub; afterwards only texts outside its main component
   meet the other chunks.
4. *Components* of the spanning links of all blocks.

No step samples, caps or drops candidates.  Equal sets form one class first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import byte_slices, free_name, narrow, tidied, Scratch
from hearth.llm.components import components
from hearth.llm.wordhash import chunks, mix, separators

K = 5
PERCENT = 75
FIRST_FRAGMENT = 0.4
BLOCK_BYTES = 32 << 20
#: Bytes of text whose n-grams a task pre-aggregates together.
GROUP_BYTES = 8 << 20
FRAGMENTS = 4
_U = np.uint64


def sets_of(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct n-gram names of each text (A-Z lower-cased)."""
    out: list[np.ndarray] = []
    for _, words in chunks(texts, True, separators()):
        names, b = words.shingles(k)
        out += [np.unique(names[b[i]:b[i + 1]]) for i in range(len(b) - 1)]
    return out


def class_name(grams: np.ndarray) -> int:
    """An even 64-bit name of a whole set, as a signed number; 0 for the empty set."""
    if not len(grams):
        return 0
    return int(mix(mix(grams).sum(keepdims=True) ^ _U(len(grams)))[0].astype(np.int64)) & ~1 or 2


def set_sizes(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, row, n_shingles, cls``: size and class (null if empty) of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = sets_of(batch.column(1), k)
            cls = np.array([class_name(g) for g in grams], dtype=np.int64)
            yield pa.record_batch({"doc_id": batch.column(0), "row": batch.column(2),
                                   "n_shingles": pa.array([len(g) for g in grams], pa.int64()), "cls": pa.array(cls, mask=cls == 0)})

    return docs.withColumn("row", F.xxhash64("text")).mapInArrow(tidied(run), "doc_id long, row long, n_shingles long, cls long")


def _fragment_rows(cls: np.ndarray, grams: list[np.ndarray], percent: int, below: float) -> pa.RecordBatch:
    """Rows (h, v) of one group of texts.  v = class: an n-gram that one class of the
    group has; v = 0: one that several have; odd v: the class h itself, with what the
    group has counted for it and how much it needs."""
    _, at = np.unique(cls, return_index=True)
    at = at[cls[at] != 0]
    bound = _U(min(int(below * 2.0**64), 2**64 - 1))
    part = [grams[i] if below >= 1 else grams[i][:np.searchsorted(grams[i], bound)] for i in at]
    size = np.array([len(x) for x in part], dtype=np.int64)
    token = np.concatenate(part) if part else np.empty(0, _U)
    own = np.repeat(np.arange(len(at)), size)
    order = np.argsort(token, kind="stable")
    token, own = token[order], own[order]
    edge = np.concatenate([[True], token[1:] != token[:-1]]) if len(token) else np.empty(0, bool)
    times = np.diff(np.append(np.flatnonzero(edge), len(token)))
    alone = np.repeat(times == 1, times)
    counted = np.bincount(own[~alone], minlength=len(at)).astype(np.int64)
    whole = np.array([len(grams[i]) for i in at], dtype=np.int64)
    needs = size - whole * (100 - percent) // 100
    stat = (((counted << 31) | (needs + (1 << 30))) << 1) | 1
    twice = token[edge][times > 1] if len(token) else token
    h = np.concatenate([token[alone].view(np.int64), twice.view(np.int64), cls[at]])
    v = np.concatenate([cls[at][own[alone]], np.zeros(len(twice), np.int64), stat])
    return pa.record_batch({"h": pa.array(h), "v": pa.array(v)})


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (h, v): per class, its n-grams that another class has and
    what it needs of them, as partial sums."""
    h, v = np.empty(0, np.int64), np.empty(0, np.int64)

    def done(h: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        stat = (v & 1) == 1
        sums = (v[stat] >> 1) >> 31, ((v[stat] >> 1) & ((1 << 31) - 1)) - (1 << 30)
        th, tv = h[~stat], v[~stat]
        credited = np.empty(0, np.int64)
        if len(th):
            start = np.flatnonzero(np.concatenate([[True], th[1:] != th[:-1]]))
            fresh = np.concatenate([[True], (th[1:] != th[:-1]) | (tv[1:] != tv[:-1])])
            several = np.add.reduceat(fresh.astype(np.int64), start) > 1
            credited = tv[np.repeat(several, np.diff(np.append(start, len(th)))) & (tv != 0)]
        who, times = np.unique(credited, return_counts=True)
        return pa.record_batch({
            "cls": pa.array(np.concatenate([h[stat], who])),
            "have": pa.array(np.concatenate([sums[0], times.astype(np.int64)])),
            "need": pa.array(np.concatenate([sums[1], np.zeros(len(who), np.int64)]))})

    for batch in batches:
        h = np.concatenate([h, batch.column(0).to_numpy()])
        v = np.concatenate([v, batch.column(1).to_numpy()])
        cut = int(np.searchsorted(h, h[-1])) if len(h) else 0
        if cut:
            yield done(h[:cut], v[:cut])
            h, v = h[cut:], v[cut:]
    if len(h):
        yield done(h, v)


def _survivors(rows: DataFrame, least: int = 0) -> DataFrame:
    """Classes whose shared n-grams suffice for a link and are ``least`` or more.  In a
    fragment none may suffice: all that two texts share can lie outside it."""
    counted = rows.repartition("h").sortWithinPartitions("h", "v").mapInArrow(
        tidied(_count_shared), "cls long, have long, need long")
    return counted.groupBy("cls").agg(F.sum("have").alias("have"), F.sum("need").alias("need")) \
        .where(f"have >= need and have >= {least}").select("cls")


def link_block(cls: np.ndarray, grams: list[np.ndarray], percent: int, visitors: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spanning links of the texts of one block.  With ``visitors`` (flags), only pairs
    with a visitor are looked at.

    Overlaps are counted fragment by fragment of the block's n-gram order and summed per
    pair.  The widest of a few tried stars serves as the hub: its texts are one component,
    so only the others are compared with all."""
    n = len(cls)
    size = np.array([len(g) for g in grams], dtype=np.int64)
    token, own = np.concatenate(grams), np.repeat(np.arange(n, dtype=np.int32), size)
    order = np.argsort(token, kind="stable")
    token, own = token[order], own[order]
    start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    rank = np.empty(len(token), np.int64)
    rank[order] = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(token))))
    ends, first = np.append(start[1:], len(token)), np.concatenate([[0], np.cumsum(size)])
    cuts = np.linspace(0, len(start), FRAGMENTS + 1).astype(np.int64)

    def linked(y: int) -> np.ndarray:
        mine = rank[first[y]:first[y + 1]]
        total = np.zeros(n, np.int64)
        for f in range(FRAGMENTS):
            part = mine[(mine >= cuts[f]) & (mine < cuts[f + 1])]
            part = part[ends[part] - start[part] > 1]
            if len(part):
                lens = ends[part] - start[part]
                at = np.repeat(start[part] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
                total += np.bincount(own[at], minlength=n)
        out = 100 * total >= percent * (size + size[y] - total)
        out[y] = False
        return np.flatnonzero(out & (total > 0))

    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return int(x)

    def join(y: int, others: np.ndarray) -> None:
        for x in others:
            a, b = find(y), find(int(x))
            if a != b:
                root[max(a, b)] = min(a, b)

    if visitors is None:
        tried = {int(y): linked(int(y)) for y in dict.fromkeys((0, n // 3, 2 * n // 3))}
        hub = max(tried, key=lambda y: len(tried[y]))
        for y, others in tried.items():
            join(y, others)
        rest = np.ones(n, bool)
        rest[tried[hub]] = False
        rest[list(tried)] = False
        scan = np.flatnonzero(rest)
    else:
        scan = np.flatnonzero(visitors)
    for y in scan:
        join(int(y), linked(int(y)))
    roots = [find(i) for i in range(n)]
    return [(int(cls[i]), int(cls[r])) for i, r in enumerate(roots) if i != r]


def _read_blob(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=_U) for x in column]


def _block_links(percent: int, chosen: bool):
    def run(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_numpy()
        flags = table.column("visitor").to_numpy(zero_copy_only=False)
        _, at = np.unique(cls, return_index=True)
        if chosen:
            flag = np.zeros(len(at), bool)
            for i, c in enumerate(at):
                flag[i] = flags[cls == cls[c]].any()
        grams = _read_blob(table.column("grams").combine_chunks().take(pa.array(at)))
        links = link_block(cls[at], grams, percent, flag if chosen else None) if len(at) > 1 else []
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return run


def ngram_components(docs: DataFrame, k: int = K, percent: int = PERCENT, first_fragment: float = FIRST_FRAGMENT,
                     block_bytes: int = BLOCK_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``.

    Two texts link when ``100 * intersection >= percent * union`` of their sets of ``k``-word
    n-grams.  A null or blank text has an empty set, links with nothing and is its own
    component; so is a row with a null key (``component_id`` null).  A text of 1 to k - 1
    words has one n-gram, its whole sequence.  Repeated rows are rows of their own in one
    component; rows that share a key but not a text stand for themselves.
    """
    return _components(narrow(docs, key, text), k, percent, first_fragment, block_bytes).drop("row", "label")


def one_per_group(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, but one of each component: that of the smallest
    key, and of several texts of that key one; of equal rows one stays.  Texts without words
    and rows with a null key all stay."""
    row = free_name(docs, "text_as_number")
    scratch = Scratch(docs.sparkSession)
    found = scratch.write(_components(narrow(docs), k, percent, FIRST_FRAGMENT, BLOCK_BYTES).where(
        "doc_id is not null and n_shingles > 0").groupBy("doc_id", "row", "label", "component_id").count())
    heads = found.df.where("doc_id = component_id").groupBy("label").agg(F.min("row").alias("head"))
    gone = scratch.write(found.df.join(heads, "label").where("doc_id != component_id or row != head").select("doc_id", "row"))
    again = scratch.write(found.df.where("count > 1").select("doc_id", "row"))
    named = docs.withColumn(row, F.xxhash64("text"))

    def among(few: DataFrame) -> F.Column:
        return (named["doc_id"].cast("long") == few["doc_id"]) & (named[row] == few["row"])

    few = gone.small()
    kept = named.join(few, among(few), "left_anti")
    if again.df.limit(1).count():
        twice = again.small().withColumnsRenamed({"doc_id": "again_id", "row": "again_row"})
        same = (kept["doc_id"].cast("long") == twice["again_id"]) & (kept[row] == twice["again_row"])
        kept = kept.join(twice, same, "left_anti").union(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", row]))
    return kept.drop(row)


def _components(docs: DataFrame, k: int, percent: int, first_fragment: float, block_bytes: int) -> DataFrame:
    """``doc_id, row, n_shingles, label, component_id`` of ``docs(doc_id, text)``; ``row`` is a number
    of the text, ``label`` one of the component (null for texts without words)."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sizes = scratch.write(set_sizes(docs, k))
    classes = sizes.df.where("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", GROUP_BYTES):
                grams = sets_of(part.column(1), k)
                cls = np.array([class_name(g) for g in grams], dtype=np.int64)
                yield _fragment_rows(cls, grams, percent, first_fragment)

    likely = scratch.write(_survivors(docs.where("doc_id is not null").mapInArrow(tidied(first), "h long, v long")).join(classes, "cls"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", GROUP_BYTES):
                grams = sets_of(part.column(1), k)
                right = [i for i, (g, c) in enumerate(zip(grams, part.column(0).to_pylist())) if class_name(g) == c]
                yield pa.record_batch({"cls": part.column(0).take(pa.array(right, pa.int64())),
                                       "n": pa.array([len(grams[i]) for i in right], pa.int64()),
                                       "grams": pa.array([grams[i].tobytes() for i in right], pa.binary())})

    texts = docs.join(likely.small().withColumnRenamed("rep", "doc_id"), "doc_id").select("cls", "text")
    sets = scratch.write(texts.mapInArrow(tidied(fetch), "cls long, n long, grams binary"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _fragment_rows(batch.column(0).to_numpy(), _read_blob(batch.column(1)), percent, 1.0)

    kept = scratch.write(_survivors(sets.df.select("cls", "grams").mapInArrow(tidied(whole), "h long, v long"), 1))
    sets_kept = sets.df.join(kept.df, "cls")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = _read_blob(batch.column(2))
            lens = [len(g) for g in grams]
            yield pa.record_batch({
                "h": pa.array(np.concatenate(grams).view(np.int64) if grams else np.empty(0, np.int64)),
                "cls": pa.array(np.repeat(batch.column(0).to_numpy(), lens)),
                "n": pa.array(np.repeat(batch.column(1).to_numpy(), lens))})

    rows = sets_kept.select("cls", "n", "grams").mapInArrow(tidied(explode), "h long, cls long, n long").distinct()
    often = rows.groupBy("h").count().where("count > 1")
    # Rarest first: n-grams that no other text has head every order; a text sends those that
    # follow them within its prefix.
    prefix = (rows.join(often, "h").groupBy("cls", "n")
              .agg(F.array_sort(F.collect_list(F.struct("count", "h"))).alias("order"))
              .select("cls", F.explode(F.expr(
                  f"slice(order, 1, greatest(0, cast(n * {100 - percent} div 100 + 1 - (n - size(order)) as int)))")).alias("g"))
              .select("cls", "g.h"))
    prefix = scratch.write(prefix)
    hubs = prefix.df.groupBy("h").agg(F.min("cls").alias("hub"), F.count("*").alias("m")).where("m > 1")
    members = scratch.write(prefix.df.join(hubs, "h").select("hub", "cls").distinct())
    sized = members.df.join(sets.df.select("cls", "n").dropDuplicates(["cls"]), "cls")
    dealt = sized.groupBy("hub").agg(F.sum("n").alias("n")).select(
        "hub", F.expr(f"cast(n * 8 div {block_bytes} + 1 as int)").alias("parts"))
    # the hub is a member of each chunk of its block
    placed = members.df.join(dealt, "hub").select(
        "hub", "cls", "parts",
        F.explode(F.when(F.col("cls") == F.col("hub"), F.sequence(F.lit(0), F.col("parts") - 1))
                  .otherwise(F.array(F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")))).alias("part"))
    placed = scratch.write(placed)
    out = "a long, b long"
    blobs = sets.df.select("cls", "grams")
    links = scratch.write(placed.df.join(blobs, "cls").withColumn("visitor", F.lit(False)).groupBy("hub", "part")
                          .applyInArrow(_block_links(percent, False), out))
    labels = components(links.df, scratch)
    if placed.df.where("parts > 1").limit(1).count():
        links = scratch.write(links.df.union(_across_chunks(placed.df.where("parts > 1"), labels, blobs, percent)))
        labels = components(links.df, scratch)
    comp = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    comp = scratch.write(comp)
    lowest = comp.df.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_class = comp.df.join(lowest, "label").select("cls", "label", "component_id")
    return sizes.df.join(by_class, "cls", "left").select(
        "doc_id", "row", "n_shingles", "label", F.expr("if(cls is null or doc_id is null, doc_id, component_id)").alias("component_id"))


def _across_chunks(placed: DataFrame, labels: DataFrame, blobs: DataFrame, percent: int) -> DataFrame:
    """Links between chunks of one block: texts outside the block's main component visit
    every chunk, themselves dealt into as many parts as their number asks for."""
    member = placed.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    main = member.groupBy("hub", "label").count().groupBy("hub").agg(F.max_by("label", "count").alias("main"))
    member = member.join(main, "hub")
    visitors = member.where("label != main").dropDuplicates(["hub", "cls"])
    share = visitors.groupBy("hub").count().join(member.groupBy("hub").agg(F.count("*").alias("all")), "hub").select(
        "hub", F.expr("1").alias("one"), "count", "all")
    visitors = visitors.join(share, "hub").withColumn(
        "deal", F.expr("cast(ceil(count * parts / all) as int)"))
    deals = visitors.select("hub", "deal").distinct()
    walk = visitors.select("hub", "cls", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.pmod(F.xxhash64("cls", F.lit(1)), F.col("deal")).cast("int").alias("visit"), F.lit(True).alias("visitor"))
    stay = member.join(deals, "hub").select(
        "hub", "cls", "part", F.explode(F.sequence(F.lit(0), F.col("deal") - 1)).alias("visit"), F.lit(False).alias("visitor"))
    return walk.union(stay).join(blobs, "cls").groupBy("hub", "part", "visit").applyInArrow(_block_links(percent, True), "a long, b long")
