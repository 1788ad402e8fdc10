"""Near-duplicate classes by ProbMinHash, banding and verification.

A text's elements are its distinct five-word shingles, weighted by one plus the
logarithm of their count.  Each element's Poisson process throws exponential
arrivals into ``REGISTERS`` registers; a process ends once its next arrival is
later than every register's, and a register keeps the element that came first,
so registers agree with the probability Jaccard similarity.  ``BANDS`` bands of
``ROWS`` registers give buckets (a pair of similarity 0.8 shares one with
probability 0.997, one of 0.85 with 0.99996).  Texts that repeat a shingle are
seated by the registers of their plain sets as well, so pairs that are alike only
in their plain sets meet too.

Texts of equal words are one node from the start.  In each bucket every node is
compared with the most central one of its buckets' leaders, then with the most
central one of each component; from then on up to ``SLOTS`` nodes a round lead,
those outside the bucket's largest component first, and leave, until one component
is left in each bucket.  So every pair of a bucket that is not yet in one component
is compared, whoever led before; no bucket's pairs are all emitted and none is cut
short.  A pair that shares several buckets is compared in the first of them.
Registers are compared where a bucket's nodes stand, by its bands' registers and
then by ``FINE`` more; pairs that agree too rarely end there, and the others are
verified on their whole texts: a link needs a similarity of 0.8 or more, of the
weighted or the plain sets.
Components are found by star rounds, each cut by a reliable checkpoint.

Defined cases: a text of one to four words is one shingle; texts without a word
(null, empty, blank) are never linked, each is its own class; a null doc_id has
a null class; rows of one doc_id are one document and so one class; an empty table
gives none.  Ties go to the smallest id: it names the class, and of nodes equally
central it leads.  Very long texts count whole; other columns are not looked at
by ``classes`` and pass unchanged through ``keep_one``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .arrays import Words, bounded_batches, map_texts, mix, texts_of, windows
from .shared import Table, among, components
from .substrings import B1, B2, run_hashes

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 8
SLOTS = 256  #: leaders of a bucket in one round
LIKELY = 0.68  #: estimated similarity under which a pair is not verified, over four deviations below 0.8
FINE, FINE_LIKELY = 1024, 0.75  #: registers of the second estimate, and the same for it: four deviations below 0.8
MEETINGS, PART = 1 << 15, 4096  #: pairs compared at a time; seats of a bucket in one place
REGISTERS = BANDS * ROWS
BAND_COLUMNS = [f"b{i}" for i in range(BANDS)]
PLAIN_COLUMNS = [f"p{i}" for i in range(BANDS)]  #: the same of the plain set; null where no shingle repeats


def shingles(words: Words, h1: np.ndarray, size: int = SHINGLE):
    """Distinct elements of each text: text, hash and count, ordered by text."""
    at, hashed = windows(words, h1, size)
    of = words.text_of[at]
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):
        whole = mix(run_hashes(h1, words.first[short], words.first[short + 1], B1) + words.count[short].astype(np.uint64))
        of, hashed = np.r_[of, short], np.r_[hashed, whole]
    order = np.lexsort((hashed, of))
    of, hashed = of[order], hashed[order]
    new = np.r_[True, (of[1:] != of[:-1]) | (hashed[1:] != hashed[:-1])] if len(of) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return of[first], hashed[first], np.diff(np.r_[first, len(of)])


def signatures(of: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The element that each register keeps (0 where a text has none)."""
    best = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, np.uint64)
    time, active, k = np.zeros(len(of)), np.arange(len(of)), 0
    while len(active):
        k += 1
        with np.errstate(over="ignore"):
            draw = mix(element[active] + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15))
            spot = (mix(draw ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(registers)).astype(np.int64)
        unit = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[active] -= np.log(unit) / weight[active]
        place, now = of[active] * registers + spot, time[active]
        np.minimum.at(best, place, now)
        won = now == best[place]
        kept[place[won]] = element[active[won]]
        limit = best.reshape(texts, registers).max(axis=1)
        active = active[now < limit[of[active]]]
    return kept.reshape(texts, registers)


def band_keys(kept: np.ndarray) -> np.ndarray:
    """One value per band: a byte of each of its registers."""
    return np.ascontiguousarray((mix(kept) >> np.uint64(56)).astype(np.uint8)).view(np.uint64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Probability Jaccard of two weighted sets (sorted elements, weights), and plain Jaccard."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(both)
    if not len(both):
        return 0.0, 0.0
    wa, wb = a[1][i], b[1][j]
    ratio = wa / wb
    order = np.argsort(-ratio, kind="stable")
    r, sa, sb = ratio[order], np.cumsum(wa[order]), np.cumsum(wb[order][::-1])[::-1]
    begin = np.searchsorted(-r, -r, "left")  # shared elements of a larger ratio count by a, the rest by b
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    over = np.r_[0.0, sa][begin] + only_a
    under = sb[begin] + only_b
    return float((1 / (over / wa[order] + under / wb[order])).sum()), len(both) / union


def sketch(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprint of its words, number of words, band keys."""
    names = ["doc_id", "d1", "d2", "n_words", *BAND_COLUMNS, *PLAIN_COLUMNS]

    def work(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = Words(texts)
        h1, h2 = words.hashes(1), words.hashes(2)
        begin, end = words.first[:-1], words.first[1:]
        d1 = run_hashes(h1, begin, end, B1) if len(h1) else np.zeros(len(texts), np.uint64)
        d2 = run_hashes(h2, begin, end, B2) if len(h2) else np.zeros(len(texts), np.uint64)
        of, element, count = shingles(words, h1)
        keys = band_keys(signatures(of, element, 1 + np.log(count), len(texts))).view(np.int64)
        plain, alone = np.zeros_like(keys), np.ones(len(texts), bool)
        many = np.unique(of[count > 1])
        if len(many):
            at = np.isin(of, many)
            plain[many] = band_keys(signatures(np.searchsorted(many, of[at]), element[at], np.ones(at.sum()), len(many))).view(np.int64)
            alone[many] = False
        columns = [rows.column(0), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(words.count)]
        columns += [pa.array(np.ascontiguousarray(keys[:, i])) for i in range(BANDS)]
        return pa.RecordBatch.from_arrays(columns + [pa.array(np.ascontiguousarray(plain[:, i]), mask=alone) for i in range(BANDS)], names)

    return map_texts(docs, work, "doc_id long, d1 long, d2 long, n_words long, " + ", ".join(f"{b} long" for b in (*BAND_COLUMNS, *PLAIN_COLUMNS)))


def fine_sketch(texts: DataFrame) -> DataFrame:
    """Per node ``FINE`` one-byte registers of the weighted set, then of the plain set (null where both sets are the same)."""

    def work(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = Words(texts)
        of, element, count = shingles(words, words.hashes(1))
        weighted = band_keys(signatures(of, element, 1 + np.log(count), len(texts), FINE)).view(np.uint8)
        many = np.unique(of[count > 1])
        at = np.isin(of, many)
        plain = [None] * len(texts)
        for i, kept in zip(many, band_keys(signatures(np.searchsorted(many, of[at]), element[at], np.ones(at.sum()), len(many), FINE)).view(np.uint8)):
            plain[i] = kept.tobytes()
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array([x.tobytes() for x in weighted], pa.binary()), pa.array(plain, pa.binary())], ["node", "fine", "plain"])

    return map_texts(texts, work, "node long, fine binary, plain binary", ("node", "text"))


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity: the share of equal registers, less what equal bytes give by chance."""
    return ((x == y).mean(axis=1) - 1 / 256) * 256 / 255


def registers(nodes: DataFrame) -> DataFrame:
    """Nodes with their bands' registers of the weighted set (k) and of the plain set (kp)."""
    weighted, plain = F.array(*BAND_COLUMNS), F.array(*PLAIN_COLUMNS)
    return nodes.select("node", weighted.alias("k"), F.when(F.col(PLAIN_COLUMNS[0]).isNotNull(), plain).otherwise(weighted).alias("kp"))


def likely(pairs: DataFrame, nodes: DataFrame, least: float = LIKELY) -> DataFrame:
    """The pairs (a, b) whose registers, of the weighted or the plain sets, agree often enough.  ``nodes`` is (node, k, kp)."""
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("k").alias(f"k{name}"), F.col("kp").alias(f"p{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ka", "kb", "pa", "pb")
    bounded_batches(pairs.sparkSession)

    def run(batches):
        for batch in batches:
            x, y, p, q = (batch.column(i).flatten().to_numpy(zero_copy_only=False).view(np.uint8).reshape(len(batch), REGISTERS) for i in (2, 3, 4, 5))
            keep = pa.array(np.maximum(agreement(x, y), agreement(p, q)) >= least)
            yield batch.select(["a", "b"]).filter(keep)

    return both.mapInArrow(run, "a long, b long")


def meet(seats: DataFrame, lead: DataFrame, nodes: DataFrame, least: float = LIKELY, fine_least: float = FINE_LIKELY) -> DataFrame:
    """The pairs (a, b) of a seat and a leader of its bucket, of different components, whose registers agree often enough.

    ``seats`` is (band, key, node, r, parts), ``lead`` (band, key, leader, lr, parts),
    ``nodes`` (node, k, kp, fine, plain).  A bucket's seats are dealt to ``parts``
    places, each of which gets its leaders (at most ``SLOTS``) first; registers are
    compared there, and only the pairs that agree are made rows.  A pair whose
    weighted registers put it into an earlier band's bucket is left to that one.
    """
    here = seats.select("band", "key", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"), F.lit(0).alias("seat"), "node", "r")
    places = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    here = here.union(lead.select("band", "key", places, F.lit(-1).alias("seat"), F.col("leader").alias("node"), F.col("lr").alias("r")))
    dealt = here.join(nodes, "node").select("band", "key", "part", "seat", "node", "r", "k", "kp", "fine", F.coalesce("plain", "fine").alias("plain"))
    dealt = dealt.repartition("band", "key", "part").sortWithinPartitions("band", "key", "part", "seat")
    bounded_batches(seats.sparkSession)

    def run(batches):
        kept = None  # the leaders of the bucket that the last batch ended in
        for batch in batches:
            if not len(batch):
                continue
            x = [batch.column(i).to_numpy() for i in range(6)]
            x += [batch.column(i).flatten().to_numpy(zero_copy_only=False).view(np.uint8).reshape(len(batch), REGISTERS) for i in (6, 7)]
            x += [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(len(batch), FINE) for i in (8, 9)]
            if kept is not None:
                x = [np.concatenate(c) for c in zip(kept, x)]
            band, key, part, seat, node, r, coarse, coarse_plain, fine, plain = x
            keys = coarse.view(np.int64)
            new = np.r_[True, (band[1:] != band[:-1]) | (key[1:] != key[:-1]) | (part[1:] != part[:-1])]
            of, start = np.cumsum(new) - 1, np.flatnonzero(new)
            leaders = np.bincount(of[seat < 0], minlength=len(start))
            kept = [c[start[-1] : start[-1] + leaders[-1]].copy() for c in x]
            at = np.flatnonzero(seat == 0)
            done = np.cumsum(leaders[of[at]])
            for few in np.split(at, np.searchsorted(done, np.arange(MEETINGS, done[-1] if len(done) else 0, MEETINGS))):
                n = leaders[of[few]]
                i = np.repeat(few, n)
                j = np.repeat(start[of[few]] - (np.cumsum(n) - n), n) + np.arange(len(i))
                near = np.flatnonzero(r[i] != r[j])
                i, j = i[near], j[near]
                # places of the first band that both share by their weighted registers
                same = keys[i] == keys[j]
                near = np.flatnonzero(~same.any(axis=1) | (same.argmax(axis=1) >= band[i]))
                i, j = i[near], j[near]
                near = np.flatnonzero(np.maximum(agreement(coarse[i], coarse[j]), agreement(coarse_plain[i], coarse_plain[j])) >= least)
                i, j = i[near], j[near]
                near = np.maximum(agreement(fine[i], fine[j]), agreement(plain[i], plain[j])) >= fine_least
                a, b = node[i[near]], node[j[near]]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose texts (node, text) are similar enough, with both similarities."""
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    bounded_batches(pairs.sparkSession)

    def elements(text: bytes):
        words = Words([text])
        _, e, n = shingles(words, words.hashes(1))
        return e, 1 + np.log(n)

    def run(batches):
        key, kept = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ta, tb = texts_of(batch.column(2)), texts_of(batch.column(3))
            out = []
            for i in range(len(a)):
                if b[i] != key:
                    key, kept = b[i], elements(tb[i])
                weighted, plain = similarity(elements(ta[i]), kept)
                if max(weighted, plain) >= threshold - 1e-12:
                    out.append((a[i], b[i], weighted, plain))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, [pa.int64(), pa.int64(), pa.float64(), pa.float64()])], ["a", "b", "weighted", "plain"])

    return both.mapInArrow(run, "a long, b long, weighted double, plain double")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the smallest doc_id of its class), n_words."""
    sketched = Table(sketch(docs)).df
    known = sketched.where("doc_id is not null and n_words > 0")
    nodes = Table(known.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), *[F.min(b).alias(b) for b in (*BAND_COLUMNS, *PLAIN_COLUMNS)])).df
    # rows of one doc_id are one document
    repeated = Table(known.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    keyed = lambda columns: F.transform(F.array(*columns), lambda key, band: F.struct(band.alias("band"), key.alias("key")))
    every = F.when(F.col(PLAIN_COLUMNS[0]).isNull(), keyed(BAND_COLUMNS)).otherwise(F.array_distinct(F.concat(keyed(BAND_COLUMNS), keyed(PLAIN_COLUMNS))))
    bands = nodes.select("node", F.explode(every).alias("s")).select("node", "s.band", "s.key")
    full = bands.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    seated = Table(bands.join(full, ["band", "key"]).select("band", "key", "node", "n"))
    # the node with most neighbours in its buckets, ties to the smallest, is the likeliest centre of a group
    wanted = Table(seated.df.groupBy("node").agg(F.sum("n").alias("w")))
    seats = Table(seated.df.join(wanted.df, "node").select("band", "key", "node", "w"))
    texts = among(docs.select(F.col("doc_id").alias("node"), "text"), wanted.df.select("node"))
    if repeated.n:
        texts = texts.groupBy("node").agg(F.max_by("text", F.length("text")).alias("text"))
    texts = Table(texts).df
    rank = F.struct("w", (-F.col("node")).alias("m"))
    leaders = seats.df.groupBy("band", "key").agg(F.max(rank).alias("lead"))
    nearest = seats.df.join(leaders, ["band", "key"]).groupBy(F.col("node").alias("a")).agg((-F.max("lead")["m"]).alias("b")).where("a <> b")
    links = verify(likely(nearest, registers(nodes)), texts, threshold).select("a", "b")
    if repeated.n:
        twice = known.join(repeated.df, "doc_id", "left_semi").join(nodes.select("d1", "d2", "node"), ["d1", "d2"])
        links = links.union(twice.where("doc_id <> node").select("doc_id", "node"))
    roots = components(links)
    fine, heads = None, True  # in the first round the most central node of each component leads
    held = seats.df.join(roots.df, "node", "left").select("band", "key", "node", "w", F.coalesce("root", "node").alias("r"))
    while True:
        # a bucket of one component is done; its largest component never has to lead
        parts = held.groupBy("band", "key", "r").agg(F.count("*").alias("n"))
        open_ = parts.groupBy("band", "key").agg(F.max(F.struct("n", "r"))["r"].alias("most"), F.count("*").alias("many"), F.ceil(F.sum("n") / PART).alias("parts")).where("many > 1").drop("many")
        left = Table(held.join(open_, ["band", "key"]))
        if not left.n:
            break
        if fine is None:  # the nodes of later rounds are among those of the first
            apart = fine_sketch(texts.join(left.df.select("node").distinct(), "node", "left_semi"))
            fine = Table(registers(nodes).join(apart, "node")).df
        free = left.df.where("r <> most")
        if heads:
            free = free.groupBy("band", "key", "r").agg(F.max(F.struct("w", (-F.col("node")).alias("m"), "node"))["node"].alias("node"), F.max("w").alias("w"), F.max("parts").alias("parts"))
        # at most SLOTS rows of each bucket and task are dealt
        lead = free.withColumn("n", F.row_number().over(Window.partitionBy("band", "key").orderBy(F.desc("w"), "node"))).where(F.col("n") <= SLOTS)
        lead = Table(lead.select("band", "key", F.col("node").alias("leader"), F.col("r").alias("lr"), "parts"))
        heads = False
        pairs = Table(meet(left.df, lead.df, fine).distinct())
        found = Table(verify(pairs.df, texts, threshold).select("a", "b")).df
        of = left.df.select("node", "r").distinct()
        apart = found.join(of.toDF("a", "ra"), "a").join(of.toDF("b", "rb"), "b")
        # only components are linked from here on
        merged = components(apart.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        if merged.n:
            known_roots = roots.df.join(merged.df.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
            new = merged.df.join(roots.df.select("node"), "node", "left_anti").select("node", "root")
            roots = Table(known_roots.union(new))
        # a leader has met every other node of its bucket
        rest = left.df.join(lead.df.select("band", "key", F.col("leader").alias("node")), ["band", "key", "node"], "left_anti")
        held = rest.join(merged.df.toDF("r", "top"), "r", "left").select("band", "key", "node", "w", F.coalesce("top", "r").alias("r"))
    ids = sketched.select("doc_id", "d1", "d2", "n_words")
    named = ids.join(nodes.select("d1", "d2", "node"), ["d1", "d2"], "left").select("doc_id", "n_words", F.when(F.col("n_words") > 0, F.col("node")).alias("node"))
    return named.join(roots.df, "node", "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "node", "doc_id")).alias("class_id"), "n_words")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its class; rows without doc_id stay."""
    gone = classes(docs, threshold).where("class_id <> doc_id").select(F.col("doc_id").alias("_sl_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_sl_gone"], "left_anti")
