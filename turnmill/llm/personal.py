"""Problem 5: personal information in free text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.session import cut, ship, table

PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}

# Words that say of a number what it is (part of the identifier, not of its surroundings).
_ID_WORDS = r"ssn|social[ -]security(?: number| no\.?)?|tax (?:id|no\.?|number)|steuer-?id|tin|nif|dni|passport(?: no\.?| number)?|reisepass|passeport|pasaporte|driver'?s? licen[cs]e(?: no\.?| number)?|licen[cs]e no\.?|id card(?: no\.?| number)?|national id|ni number|nino"
# Street types before or after the street's name. Only those of SEED_TYPES make an address by themselves; the others, and types not listed, are learnt.
_TYPE_AFTER = r"street|st\.?|avenue|ave\.?|road|rd\.?|lane|ln\.?|boulevard|blvd\.?|drive|dr\.?|court|ct\.?|way|square|place|terrace|close|crescent|parkway|highway"
_TYPE_BEFORE = r"rue|avenue|boulevard|place|calle|avenida|plaza|paseo|rua|travessa|via|viale|piazza|улица|ул\.?"
_TYPE_JOINED = r"(?:stra(?:ß|ss)e|str\.|gasse|weg|platz|allee|gatan|vägen)"
_S = r"[ \t ]"

#: Street types whose addresses are seeds.
SEED_TYPES = ("street", "avenue", "rue", "calle", "straße", "strasse")

# An address with @; one spelled out by marks that are sure (seeds); one by other words, which only its surroundings can tell.
_WRITTEN = re.compile(r"(?<![\w.+%-])[\w.+%-]+@" + _S + r"?[\w-]+(?:\.[\w-]+)+")
_SPELLED = re.compile(rf"(?<![\w.+%-])[\w.+%-]+{_S}*(?:\((?:at|arroba)\)|\[at\]|{{at}}|{_S}AT{_S}){_S}*[\w-]+(?:{_S}*(?:\((?:dot|punto)\)|\[dot\]|{{dot}}|{_S}DOT{_S}){_S}*[\w-]+)+")
_LOOSE = re.compile(rf"(?<![\w.+%-])[\w.+%-]+{_S}*([(\[{{]\w{{1,8}}[)\]}}]|{_S}(?:at|arroba){_S}){_S}*[\w-]+(?:{_S}*([(\[{{]\w{{1,8}}[)\]}}]|\.|{_S}(?:dot|punto|punkt|point){_S}){_S}*[\w-]+)+")
ADDRESS = re.compile(
    rf"(?i)(?<![\w.:/-])\d{{1,5}}{_S}?[a-z]?{_S}+(?:(?:north|south|east|west|[nsew]\.?){_S}+)?[^\W\d_][\w'-]*(?:{_S}+[^\W\d_][\w'-]*)?{_S}+(?:{_TYPE_AFTER})(?!\w)(?:,?{_S}+(?:apt|unit|suite|flat|no)\.?{_S}+\w+)?"
    rf"|(?<![\w.:/-])\d{{1,5}}{_S}?(?:bis|ter|[a-z])?,?{_S}+(?:{_TYPE_BEFORE})(?:{_S}+(?:de|du|des|la|le|da|do|del|di))*{_S}+(?:[dl]['’])?[^\W\d_][\w'-]*"
    rf"|(?<!\w)(?:{_TYPE_BEFORE})(?:{_S}+(?:de|du|des|la|le|da|do|del|di))*{_S}+[^\W\d_][\w'-]*,?{_S}+(?:n[º°.]?{_S}*)?\d{{1,5}}[a-z]?(?![\w:])"
    rf"|(?<!\w)[^\W\d_][\w-]*{_TYPE_JOINED}{_S}+\d{{1,5}}{_S}?[a-z]?(?![\w:])"
)
_TYPE = re.compile(rf"(?i)(?<!\w)(?:{_TYPE_AFTER}|{_TYPE_BEFORE})(?!\w)|{_TYPE_JOINED}")
# A house number and two capitalised words, the second of which may be a street type that is not listed.
_HOUSE = re.compile(rf"(?<![\w.:/-])\d{{1,5}}[a-z]?{_S}+([^\W\d_a-z][^\W\d_]+){_S}+([^\W\d_a-z][^\W\d_]+)(?!\w)")
_ID_LEAD = re.compile(rf"(?i)(?<!\w)(?:{_ID_WORDS}){_S}*[:#]?{_S}*$")
NUMBER = re.compile(r"(?<![\w@/.-])(?:[A-Z]{1,2}[ -]?)?[+(]{0,2}\d(?:[  .()/–-]{0,2}\d){4,}(?:[ -]?[A-Z](?!\w))?(?![\w@])")
_LINK = re.compile(r"https?://\S+")
_DOT = re.compile(r"\b(?:dot|DOT|punto|punkt|point)\b|[(\[{]\w{1,8}[)\]}]")
_GAP, _INITIAL = re.compile(rf"{_S}+|,{_S}+"), re.compile(rf",?{_S}+[A-Za-z]\.?{_S}+")
_DIGIT = re.compile(r"\d")
_DIGITS = re.compile(r"\d[\d  .()/–-]{3,}\d")
# What an address has at least; a text without any of these is not matched further.
_STREET = re.compile(r"(?i)str|st\b|ave|road|rd\b|lane|ln\b|boul|blvd|drive|dr\b|court|ct\b|way|squ|place|terr|close|cres|park|rue|calle|plaza|paseo|rua|trav|via|piazza|ул|gasse|weg|platz|allee|gatan|väg")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_BREAK = re.compile(r"[.!?](?=\s|$)|[\r\n]+|\s-\s|;\s")
_WORD = re.compile(r"[\w'’]+|[^\w\s]")


def affixes(names: list[str], least: int = 3) -> tuple[set[str], set[str]]:
    """Beginnings and endings that at least ``least`` of the names share."""
    a, z = Counter(), Counter()
    for n in set(names):
        for k in range(2, len(n) - 1):
            a[n[:k]] += 1
            z[n[k:]] += 1
    return {x for x, c in a.items() if c >= least}, {x for x, c in z.items() if c >= least}


class Names:
    """Listed names, and the beginnings and endings that they are made of."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.sets = {k: {n.lower() for n, kind in rows if kind == k and n} for k in ("given", "family")}
        self.parts = {k: affixes(sorted(s)) for k, s in self.sets.items()}
        self.known: dict[str, tuple[str, str]] = {}

    def status(self, token: str) -> tuple[str, str]:
        """As given and as family name: l(isted), m(ade of known parts) or n(either)."""
        got = self.known.get(token)
        if got is None:
            if len(self.known) > 500_000:
                self.known.clear()
            t = token.lower()
            got = self.known[token] = tuple("l" if t in self.sets[k] else "m" if self._made(t, k) else "n" for k in ("given", "family"))
        return got

    def _made(self, t: str, kind: str) -> bool:
        a, z = self.parts[kind]
        return any(t[:k] in a and t[k:] in z for k in range(2, len(t) - 1))


_NEITHER = ("n", "n")


def _around(text: str, start: int, end: int) -> tuple[str, str]:
    """Two words before and one after, inside the sentence; ^ and $ at its ends. Looks as far as it must."""
    reach = 60
    while True:
        a = max(0, start - reach)
        left = text[a:start]
        cuts = [m.end() for m in _BREAK.finditer(left)]
        words = _WORD.findall(left[cuts[-1] :] if cuts else left)
        if cuts or a == 0 or len(words) > 2:  # the first of three may be the end of a longer one
            break
        reach *= 4
    reach = 40
    while True:
        right = text[end : end + reach]
        cut_ = _BREAK.search(right)
        after = _WORD.search(right[: cut_.start()] if cut_ else right)
        if cut_ or end + reach >= len(text) or after and after.end() < len(right) - 1:
            break
        reach *= 4
    return " ".join(["^", "^", *(w.lower() for w in words)][-2:]), (after.group().lower() if after else "$")


def _shape(s: str) -> str:
    return re.sub(r"\s", " ", re.sub(r"[A-Za-z]", "A", re.sub(r"\d", "9", s)))


def instances(text: str, names: Names) -> list[tuple]:
    """(start, end, kind of candidate, features, seed) of one text, in order.

    Kinds of candidates: mail, street, number, name. Seeds carry their type,
    other candidates none. The first feature is the candidate's make (words
    that spell a mail address, street type, shape of a number, how names are
    known), the others its surroundings.
    """
    out, taken = [], []
    free = lambda a, z: all(z <= x or a >= y for x, y in taken)

    def add(a: int, z: int, kind: str, make: str, seed: str | None) -> None:
        left, right = _around(text, a, z)
        out.append((a, z, kind, [f"s{make}", f"l{left}", f"r{right}", f"b{left}|{right}"], seed))
        taken.append((a, z))

    if "@" in text or _DOT.search(text):
        for m in _WRITTEN.finditer(text) if "@" in text else ():
            add(*m.span(), "mail", "@", "email")
        for form, seed in ((_SPELLED, "email"), (_LOOSE, None)):
            for m in form.finditer(text):
                if free(*m.span()):
                    add(*m.span(), "mail", "spelled" if seed else " ".join(g.strip().lower() for g in m.groups()), seed)
    if _DIGIT.search(text):
        taken += [m.span() for m in _LINK.finditer(text)] if "://" in text else []
        for m in ADDRESS.finditer(text) if _STREET.search(text) else ():
            if free(*m.span()):
                kind = _TYPE.search(m.group()).group().lower().rstrip(".")
                add(*m.span(), "street", kind, "address" if kind in SEED_TYPES else None)
        for m in _HOUSE.finditer(text):
            if free(*m.span()) and m.group(1)[0].isupper() and m.group(2)[0].isupper():
                add(*m.span(), "street", m.group(2).lower(), None)
        for m in NUMBER.finditer(text) if _DIGITS.search(text) else ():
            a, z = m.span()
            # Blanks and a colon before the number may be any; what stands before them is shorter than 40 characters.
            upto = len(text[:a].rstrip("\t \xa0:#"))
            lead = _ID_LEAD.search(text, max(0, upto - 40), a)
            # The pattern's own letters before a number may be the end of such a word.
            if not free(a, z):
                continue
            s = m.group()
            digits = sum(c.isdigit() for c in s)
            if lead:
                seed, first = "id_number", lead.start()
            else:
                first = a
                seed = "phone" if (s[0] == "+" or s.startswith("00")) and 9 <= digits <= 15 or re.fullmatch(r"\(\d{3}\) ?\d{3}[- ]\d{4}", s) else None
            left, right = _around(text, first, z)
            out.append((a, z, "number", [f"s{_shape(s)}", f"l{left}", f"r{right}", f"b{left}|{right}"], seed))
            taken.append((a, z))
    words = _TOKEN.findall(text)
    known, status = names.known.get, names.status
    seen = [known(t) or status(t) for t in words]
    # Only tokens beside one that may be a name can begin one.
    named = [i for i, x in enumerate(seen) if x != _NEITHER]
    if not named:
        return sorted(out, key=lambda x: x[:2])
    found = [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(text)]
    near = sorted({j for i in named for j in (i - 2, i - 1, i) if j >= 0})
    done = -1
    for i in near:
        if i < done or i >= len(found) - 1:
            continue
        a, b = found[i], None
        for j in (i + 1, i + 2):
            if j >= len(found):
                break
            gap = text[a[1] : found[j][0]]
            if len(found[j][2]) < 2:
                continue
            if seen[i] == seen[j] == _NEITHER:
                continue
            if j == i + 1 and _GAP.fullmatch(gap) or j == i + 2 and _INITIAL.fullmatch(gap):
                one, two = (seen[i][0], seen[j][1]), (seen[j][0], seen[i][1])
                best = min((p for p in ((*one, "gf"), (*two, "fg"))), key=lambda p: (p[0] + p[1]).count("n") * 10 + (p[0] + p[1]).count("m"))
                case = lambda t: "U" if t.isupper() and len(t) > 1 else "T" if t[0].isupper() else "l"
                both = "n" not in best[:2]
                # One name beside a word that is none of either: a candidate only if both are written alike and not small.
                half = best[1] != "n" and case(a[2]) == case(found[j][2]) != "l" and "," not in gap or best[:2] == ("l", "n") and case(a[2]) == case(found[j][2]) == "T" and "," not in gap
                if both or half:
                    b = (j, best)
                    break
        if b and free(a[0], found[b[0]][1]):
            j, best = b
            left, right = _around(text, a[0], found[j][1])
            # With one name unknown, only the surroundings as a whole can tell.
            parts = [f"l{left}", f"r{right}"] if "n" not in best[:2] else []
            out.append((a[0], found[j][1], "name", [f"p{best[0]}{best[1]}", *parts, f"b{left}|{right}"], "name" if best[:2] == ("l", "l") else None))
            done = j + 1
    return sorted(out, key=lambda x: x[:2])


def texts(spark: SparkSession, root: str) -> DataFrame:
    """(origin, record_id, part, text): message texts, and both contents of reply pairs."""
    m = table(spark, root, "message").select(F.lit("message").alias("origin"), F.col("rowid").alias("record_id"), F.lit(0).alias("part"), "text")
    p = table(spark, root, "reply_pair").select(F.lit("reply_pair").alias("origin"), F.col("pair_id").alias("record_id"), F.posexplode(F.transform("messages", lambda x: x["content"])).alias("part", "text"))
    return m.unionByName(p).where("record_id is not null and text is not null")


def candidates(rows: DataFrame, name_list: DataFrame) -> DataFrame:
    """Every candidate of every text, written once.

    The name list is a reference table that does not grow with the data
    (checked: at most a million names); it goes to the workers whole.
    """
    listed = name_list.where("name is not null and kind in ('given', 'family')").select("name", "kind").distinct()
    if (n := listed.count()) > 1_000_000:
        raise ValueError(f"{n} names are too many to send to every worker")
    ship(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast([tuple(r) for r in listed.collect()])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Names(sent.value)
        known: dict[str, list] = {}
        for pdf in batches:
            out = []
            for o, i, p, t in zip(pdf["origin"], pdf["record_id"], pdf["part"], pdf["text"]):
                got = known.get(t)
                if got is None:
                    if len(known) > 50_000:
                        known.clear()
                    got = instances(t, names)
                    if len(t) < 80:
                        known[t] = got
                out += [(o, i, p, a, z, kind, t[a:z].lower(), feats, seed) for a, z, kind, feats, seed in got]
            yield pd.DataFrame(out, columns=["origin", "record_id", "part", "a", "z", "class", "span", "feats", "seed"])

    return cut(rows.mapInPandas(find, "origin string, record_id long, part int, a int, z int, class string, span string, feats array<string>, seed string"))


#: What surroundings and make must reach together, surroundings at least, and make if alone. Rounds without an end are an error.
TOGETHER, AROUND, ALONE, MAX_ROUNDS = 0.5, 0.25, 0.9, 60
#: What a candidate of each kind can be.
TYPES = {"mail": ("email",), "street": ("address",), "number": ("phone", "id_number"), "name": ("name",)}
_KINDS = ("email", "address", "phone", "id_number", "name")


def _round(nodes: DataFrame) -> DataFrame:
    """Score every pattern by the labels it joins, then every candidate by its patterns.

    Edges are counted before the shuffle. How names are known has nine values
    at most: their scores go to every task, since each may join a third of
    all candidates. The others meet their candidates in a join that skew
    handling can split, a pattern being one row there.
    """
    edges = nodes.select("node", "class", "label", F.explode("feats").alias("f"))
    stats = edges.groupBy("class", "f").agg(F.count("*").alias("n"), *((F.count_if(F.col("label") == t) / (F.count("*") + 0.5)).alias(t) for t in _KINDS))
    few = F.col("f").startswith("p")
    met = edges.where(~few).join(stats.where(~few).hint("merge"), ["class", "f"]).unionByName(edges.where(few).join(F.broadcast(stats.where(few)), ["class", "f"]))
    met = met.withColumn("p", F.substring("f", 1, 1))
    of = lambda t, *ps: F.max(F.when(F.col("p").isin(*ps), F.col(t)))
    sums = met.groupBy("node").agg(
        F.max(F.when(F.col("p") == "b", F.col("n"))).alias("bn"),
        *(F.struct(of(t, "s", "p").alias("make"), of(t, "b").alias("both"), of(t, "l").alias("l"), of(t, "r").alias("r")).alias(t) for t in _KINDS),
    )
    around = lambda t: F.when(F.col("bn") >= 3, F.col(f"{t}.both")).otherwise(F.greatest(F.col(f"{t}.both"), (F.col(f"{t}.l") + F.col(f"{t}.r")) / 2))
    total = lambda t: F.when((around(t) >= AROUND) & (around(t) + F.col(f"{t}.make") >= TOGETHER) | (F.col(f"{t}.make") >= ALONE), around(t) + F.col(f"{t}.make"))
    best = F.array_max(F.array(*(F.struct(total(t).alias("score"), F.lit(t).alias("kind")) for t in _KINDS)))
    sums = sums.select("node", F.when(best["score"].isNotNull(), best["kind"]).alias("best"))
    return nodes.join(sums.hint("merge"), "node").select("node", "class", "feats", "seed", F.coalesce("seed", "best").alias("label"))


def scored(cands: DataFrame) -> DataFrame:
    """Candidates with ``kind`` (null if none), by bootstrapped patterns.

    The graph joins each distinct candidate (class, span, surroundings) with
    its patterns: its make, the two words before, the word after, and both
    together. Seeds are labelled at first. In each round a pattern's score
    for a type is the share of candidates with that label among all that it
    joins; a candidate takes the type whose surroundings and make score
    enough together, or whose make alone is near certain, and so changes the
    patterns' scores in the next round. New makes are learnt from known
    surroundings, and new surroundings from known makes. Rare surroundings
    count by their parts. Rounds go on until no label changes (or labels come
    back to what they were in an earlier round).
    """
    open_ = cands.withColumn("node", F.xxhash64("class", "span", F.array_join("feats", "\n")))
    nodes = cut(open_.groupBy("node", "class", "feats").agg(F.max("seed").alias("seed")).withColumn("label", F.col("seed")))
    seen = set()
    for _ in range(MAX_ROUNDS):
        state = tuple(nodes.where("label is not null").agg(F.count("*"), F.sum(F.xxhash64("node", "label") % 1_000_000_007)).first())
        if state in seen:
            break
        seen.add(state)
        nodes = cut(_round(nodes))
    else:
        raise RuntimeError(f"labels still change after {MAX_ROUNDS} rounds")
    return open_.join(nodes.select("node", F.col("label").alias("kind")).hint("merge"), "node").drop("node")


def spans(spark: SparkSession, root: str) -> DataFrame:
    """(origin, record_id, part, a, z, kind): every identifier with its place."""
    return scored(candidates(texts(spark, root), table(spark, root, "name_list"))).where("kind is not null").select("origin", "record_id", "part", "a", "z", "kind")


def found(spark: SparkSession, root: str) -> DataFrame:
    """(origin, record_id, kind), each once (see TESTDATA.md). Null and empty texts hold nothing."""
    return spans(spark, root).select("origin", "record_id", "kind").distinct()


@F.pandas_udf(T.StringType())
def _fill(text: pd.Series, marks: pd.Series) -> pd.Series:
    def one(t, ms):
        if ms is None or t is None:
            return t
        out, at = [], 0
        for m in sorted(ms, key=lambda m: m["a"]):
            if m["a"] >= at:
                out += [t[at : m["a"]], PLACEHOLDERS[m["kind"]]]
                at = m["z"]
        return "".join([*out, t[at:]])

    return pd.Series([one(t, ms) for t, ms in zip(text, marks)], dtype=object)


def filled(rows: DataFrame, found_: DataFrame) -> DataFrame:
    """(origin, record_id, part, text): ``rows`` with the spans of ``found_`` replaced by placeholders."""
    ship(rows.sparkSession)
    marks = found_.groupBy("origin", "record_id", "part").agg(F.collect_list(F.struct("a", "z", "kind")).alias("marks"))
    both = rows.join(marks, ["origin", "record_id", "part"], "left")
    return both.withColumn("text", F.when(F.col("marks").isNotNull(), _fill("text", "marks")).otherwise(F.col("text"))).drop("marks")


def redacted(spark: SparkSession, root: str) -> DataFrame:
    """(origin, record_id, part, text): all texts, identifiers replaced by placeholders, the rest unchanged."""
    return filled(texts(spark, root), spans(spark, root))


def by_pattern(spark: SparkSession, root: str) -> DataFrame:
    """(kind, seeds, learnt): identifiers of each type that are seeds by their form, and those found by learnt patterns alone."""
    got = scored(candidates(texts(spark, root), table(spark, root, "name_list"))).where("kind is not null")
    return got.groupBy("kind").agg(F.count_if(F.col("seed").isNotNull()).alias("seeds"), F.count_if(F.col("seed").isNull()).alias("learnt"))


def faults(spark: SparkSession, root: str) -> DataFrame:
    """One row: contents read and put out, contents changed without an identifier, and placeholders of types that were not found there."""
    rows, marks = texts(spark, root), cut(spans(spark, root))
    kinds = marks.groupBy("origin", "record_id", "part").agg(F.collect_set("kind").alias("kinds"))
    both = rows.withColumnRenamed("text", "was").join(filled(rows, marks), ["origin", "record_id", "part"]).join(kinds, ["origin", "record_id", "part"], "left")
    times = lambda c, k: F.size(F.split(c, "\\" + PLACEHOLDERS[k]))
    odd = [(times("text", k) > times("was", k)) != F.coalesce(F.array_contains("kinds", k), F.lit(False)) for k in PLACEHOLDERS]
    any_ = odd[0]
    for x in odd[1:]:
        any_ = any_ | x
    return rows.agg(F.count("*").alias("contents")).crossJoin(
        both.agg(F.count("*").alias("put_out"), F.count_if((F.col("was") != F.col("text")) & F.col("kinds").isNull()).alias("changed_without_cause"), F.count_if(any_).alias("placeholders_amiss"))
    )
