"""Problem 4: splits that never separate related records."""

from __future__ import annotations

import math
from heapq import heappop, heappush

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.functions import text as X
from turnmill.llm.overlap import MIN_WORDS, contents
from turnmill.operators.components import components
from turnmill.session import cut, table

TARGETS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))


def label_key(label):
    """Labels with a letter without white space and case, others by their digits without leading zeros; null and blank name nobody."""
    tight = F.lower(X.squeeze_spaces(label))
    digits = F.regexp_replace(F.regexp_replace(tight, r"\P{Nd}", ""), "^0+", "")
    return F.nullif(F.when(tight.rlike(r"\p{L}"), tight).otherwise(digits), F.lit(""))


def keyed(spark: SparkSession, root: str) -> DataFrame:
    """(pair_id, label, text): the keys by which records belong together, null where there is none."""
    body = contents(F.col("messages"))
    bares = F.array_join(F.transform("messages", lambda m: X.bare(F.coalesce(m["content"], F.lit("")))), "\n")
    return table(spark, root, "reply_pair").select(
        "pair_id", "source", label_key(F.col("contact_label")).alias("label"), F.when(F.size(X.words(body)) >= MIN_WORDS, F.md5(bares.cast("binary"))).alias("text")
    )


def groups(recs: DataFrame) -> DataFrame:
    """(pair_id, group, first_pair_id) for every record.

    The graph has a node for each label and each text, and an edge for each
    distinct (label, text): copies and a contact's many records collapse
    before any join. A text with one label at most is no bridge between
    labels and is left to its label, so only bridging texts are iterated on.
    Records without any key are groups of their own.
    """
    both = recs.where("label is not null and text is not null").select("label", "text").distinct()
    bridge = both.groupBy("text").agg(F.count("*").alias("k"), F.min("label").alias("label"))
    edges = both.join(bridge.where("k > 1").select("text"), "text").select(F.concat(F.lit("c:"), "label").alias("a"), F.concat(F.lit("t:"), "text").alias("b"))
    comp = cut(components(edges))
    # A text's label (the least of them) stands for it; the label's root, if it has one, for the label.
    named = recs.join(bridge.select("text", F.col("label").alias("text_label")), "text", "left")
    named = named.withColumn("name", F.coalesce("label", "text_label"))
    node = F.when(F.col("name").isNotNull(), F.concat(F.lit("c:"), "name")).when(F.col("text").isNotNull(), F.concat(F.lit("t:"), "text")).otherwise(F.concat(F.lit("r:"), F.col("pair_id").cast("string")))
    named = named.withColumn("node", node).drop("label", "text", "text_label", "name")
    rooted = named.join(comp, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("node", "root")
    return rooted


def found(spark: SparkSession, root: str) -> DataFrame:
    """(first_pair_id, pair_id) for every record that is not its group's first (see TESTDATA.md)."""
    g = cut(groups(cut(keyed(spark, root))).select("pair_id", "group"))
    first = g.groupBy("group").agg(F.min("pair_id").alias("first_pair_id"), F.count("*").alias("k")).where("k > 1")
    return g.join(first, "group").where("pair_id <> first_pair_id").select("first_pair_id", "pair_id")


class Flow:
    """Whole groups of bundles to splits at least cost: successive shortest paths.

    Network: bundle -> (profile, split) -> split -> sink, a unit being one
    group. A bundle's j-th group beyond the whole part of its own share costs
    ``size * (j - rest of the share)``; an arc into a split costs what it
    changes the distance, in records, from the quota of the profile there,
    and likewise from the quota of all profiles (both convex). The whole
    parts of the shares are placed first, the few groups left over one by
    one, each along the cheapest path, which may move groups placed before;
    cycles of negative cost that are left are then cancelled.
    ``open`` holds what is left of the quotas, by (profile, split) and by
    (None, split); it is carried on from call to call.
    """

    def __init__(self, targets=TARGETS) -> None:
        self.targets = dict(targets)
        self.open: dict[tuple, float] = {}

    def place(self, bundles: list[tuple[int, str, int]]) -> list[dict[str, int]]:
        """Groups of each bundle (size, profile, groups) to each split; sizes should be alike."""
        splits = list(self.targets)
        got, rest = [], []
        for size, f, k in bundles:
            got.append({s: int(k * p + 1e-9) for s, p in self.targets.items()})
            rest.append({s: k * p - got[-1][s] for s, p in self.targets.items()})
            for s, p in self.targets.items():
                for key in ((f, s), (None, s)):
                    self.open[key] = self.open.get(key, 0.0) + size * (k * p - got[-1][s])
        z = sum(s * k for s, _, k in bundles) / max(1, sum(k for _, _, k in bundles))
        more = [dict.fromkeys(splits, 0) for _ in bundles]
        cost = lambda i, s, j: bundles[i][0] * (j - rest[i][s])
        profiles = {f: [] for _, f, _ in bundles}
        for i, (_, f, _) in enumerate(bundles):
            profiles[f].append(i)
        #: Bundles that have a group beyond their share in s, cheapest to move to t first; checked when taken.
        moves: dict[tuple, list] = {(f, s, t): [] for f in profiles for s in splits for t in splits if s != t}
        into = lambda key: abs(self.open[key] - z) - abs(self.open[key])
        out_of = lambda key: abs(self.open[key] + z) - abs(self.open[key])

        def offer(i: int) -> None:
            for s in splits:
                if more[i][s]:
                    for t in splits:
                        if t != s:
                            heappush(moves[bundles[i][1], s, t], (cost(i, t, more[i][t] + 1) - cost(i, s, more[i][s]), i, more[i][s], more[i][t]))

        def cheapest(f: str, s: str, t: str):
            heap = moves[f, s, t]
            while heap and (more[heap[0][1]][s], more[heap[0][1]][t]) != heap[0][2:]:
                heappop(heap)
            return heap[0] if heap else None

        def path(i: int) -> list[tuple]:
            """The cheapest way of one more group of bundle i to the sink, as steps."""
            f = bundles[i][1]
            far = {(f, s): (cost(i, s, more[i][s] + 1), None) for s in splits}
            for _ in range(3 * len(profiles) + 3):  # a path passes each node once at most
                changed = False
                for node, (d, _) in list(far.items()):
                    g, s = node
                    if g is None:  # from a split back to a profile that has a group there to move away
                        steps = [((h, s), out_of((h, s))) for h in profiles if any(moves[h, s, t] for t in splits if t != s)]
                    else:
                        steps = [((None, s), into((g, s)))] + [((g, t), m[0]) for t in splits if t != s and (m := cheapest(g, s, t))]
                    for to, c in steps:
                        if to not in far or d + c < far[to][0] - 1e-9:
                            far[to] = (d + c, node)
                            changed = True
                if not changed:
                    break
            end = min(((None, s) for s in splits if (None, s) in far), key=lambda n: far[n][0] + into(n))
            steps, node = [], end
            while node is not None and len(steps) <= len(far):
                steps.append(node)
                node = far[node][1]
            return steps[::-1]

        for i in sorted((i for i in range(len(bundles)) for _ in range(bundles[i][2] - sum(got[i].values()))), key=lambda i: -bundles[i][0]):
            way = path(i)
            more[i][way[0][1]] += 1
            offer(i)
            for (g, s), (h, t) in zip(way, way[1:]):
                if g is not None and h is None:
                    self.open[g, s] -= z
                elif g is None:
                    self.open[h, s] += z
                elif m := cheapest(g, s, t):
                    more[m[1]][s] -= 1
                    more[m[1]][t] += 1
                    offer(m[1])
            self.open[way[-1]] -= z
        for i, (size, f, _) in enumerate(bundles):  # the quotas go on with the sizes as they are, not as the band's mean
            for s in splits:
                for key in ((f, s), (None, s)):
                    self.open[key] += more[i][s] * (z - size)
        out = [{s: g[s] + m[s] for s in splits} for g, m in zip(got, more)]
        for f in profiles:
            self.settle(bundles, out, profiles[f], f)
        return out

    def settle(self, bundles: list[tuple[int, str, int]], out: list[dict[str, int]], which, profile: str | None) -> None:
        """Cancel cycles of negative cost that whole parts leave: what larger groups took of a quota, smaller ones give back.

        Inside a profile, where both its quota and that of all are nearer
        then; or, without one, for the quotas of all alone, which come first.
        Each bundle gives in proportion to what it has there.
        """
        z = max((bundles[i][0] for i in which), default=1)
        for s in self.targets:
            for t in self.targets:
                over = min(-self.open[profile, s], -self.open[None, s])
                short = min(self.open[profile, t], self.open[None, t])
                have = sum(out[i][s] for i in which)
                n = min(int(min(over, short) / z), have)
                if n <= 0:
                    continue
                left = n
                for i in sorted(which, key=lambda i: -bundles[i][0]):
                    k = min(left, out[i][s], -(-n * out[i][s] // have))
                    out[i][s], out[i][t], left = out[i][s] - k, out[i][t] + k, left - k
                    for key in {(bundles[i][1]), None}:
                        self.open[key, s] += k * bundles[i][0]
                        self.open[key, t] -= k * bundles[i][0]


def allocate(bundles: list[tuple[int, str, int]], targets=TARGETS) -> list[list[tuple[str, int]]]:
    """How many whole groups of each bundle (size, profile, groups) go to which split.

    Bundles are placed by bands of size (within a factor of the root of two),
    the largest first, so that what whole groups leave of a quota is met by
    smaller ones, and every band is spread over the splits as they ask.
    """
    flow, bands = Flow(targets), {}
    for i, (size, _, _) in enumerate(bundles):
        bands.setdefault(int(2 * math.log2(size)), []).append(i)
    placed: dict[int, dict[str, int]] = {}
    for band in sorted(bands, reverse=True):
        placed |= dict(zip(bands[band], flow.place([bundles[i] for i in bands[band]])))
    for band in sorted(bands, reverse=True):  # what a profile could not make up for by itself
        flow.settle(bundles, placed, bands[band], None)
    return [[(s, placed[i][s]) for s, _ in targets if placed[i][s]] for i in range(len(bundles))]


def assign(spark: SparkSession, root: str, targets=TARGETS) -> DataFrame:
    """(pair_id, group_first, new_split): a new split for every record.

    Groups are bundled by size and by profile (their most frequent source,
    one of few); only the bundle table (distinct sizes times sources, far
    fewer than groups: sizes sum to the number of records) goes to the
    driver. Members of a bundle take their split by their rank in hash order
    inside one of 64 slices, with slice counts carried over, so no task
    ranks a whole bundle.
    """
    g = cut(groups(cut(keyed(spark, root))).select("pair_id", "group", "source"))
    sized = g.groupBy("group").agg(F.count("*").alias("size"), F.min("pair_id").alias("group_first"), F.coalesce(F.mode("source", True), F.lit("")).alias("profile"))
    sized = cut(sized.withColumn("slice", F.pmod(F.xxhash64("group"), F.lit(64))))
    table_ = sized.groupBy("size", "profile").agg(F.count("*").alias("k")).orderBy(F.desc("size"), "profile").collect()
    plan = allocate([(r["size"], r["profile"], r["k"]) for r in table_], targets)
    rows, at = [], 0
    for r, sent in zip(table_, plan):
        at = 0
        for s, k in sent:
            rows.append((r["size"], r["profile"], at, at + k, s))
            at += k
    spans = spark.createDataFrame(rows or [], "size long, profile string, lo long, hi long, new_split string")
    counts = sized.groupBy("size", "profile", "slice").agg(F.count("*").alias("k"))
    skip = counts.select("size", "profile", "slice", F.coalesce(F.sum("k").over(Window.partitionBy("size", "profile").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("skip"))
    rank = F.row_number().over(Window.partitionBy("size", "profile", "slice").orderBy(F.xxhash64("group", F.lit(1)), "group")) - 1
    placed = sized.withColumn("r", rank).join(skip, ["size", "profile", "slice"]).withColumn("pos", F.col("r") + F.col("skip"))
    chosen = placed.join(spans, ["size", "profile"]).where("pos >= lo and pos < hi").select("group", "group_first", "new_split")
    return g.select("pair_id", "group").join(chosen, "group").select("pair_id", "group_first", "new_split")


def balance(spark: SparkSession, root: str) -> DataFrame:
    """(new_split, source, records, share, groups, mean_size) of each new split and source: how alike the splits are.

    ``share`` is the part of the source's records that the split has, to be
    held against the target; ``groups`` and ``mean_size`` count the groups
    with records of the source there. Null sources are one.
    """
    got = assign(spark, root).join(table(spark, root, "reply_pair").select("pair_id", "source"), "pair_id")
    cell = got.groupBy("new_split", "source").agg(F.count("*").alias("records"), F.countDistinct("group_first").alias("groups"))
    of = cell.groupBy(F.col("source").alias("of_source")).agg(F.sum("records").alias("of"))
    both = cell.join(of, F.col("source").eqNullSafe(F.col("of_source")))
    return both.select("new_split", "source", "records", (F.col("records") / F.col("of")).alias("share"), "groups", (F.col("records") / F.col("groups")).alias("mean_size"))


def faults(spark: SparkSession, root: str) -> DataFrame:
    """One row: records placed, records without a split or with two, groups that are not in one split."""
    got = cut(assign(spark, root))
    per = got.groupBy("pair_id").agg(F.countDistinct("new_split").alias("k"), F.count("new_split").alias("n"))
    groups = got.groupBy("group_first").agg(F.countDistinct("new_split").alias("k"))
    return per.agg(F.count("*").alias("records"), F.count_if((F.col("k") != 1) | (F.col("n") != 1)).alias("not_placed_once")).crossJoin(groups.agg(F.count_if(F.col("k") != 1).alias("groups_parted")))
