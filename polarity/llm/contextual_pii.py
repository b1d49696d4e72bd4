"""Personal data by bootstrapped contextual extraction (operator 12).

Base patterns find well-formed identifiers, the seeds.  Every identifier-like
string (an instance) votes for the lexical patterns around it: the word
before, the two words before, the word before and the one after.  Rounds over
the graph of patterns and instances score the patterns by the share of their
instances that are known, and accept malformed instances that stand in a
trusted pattern of their kind; accepted instances count as known in the next
round.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.llm.salting import salted_join
from polarity.llm.tables import packed, unpacked, written

KINDS = ("email", "ip", "card", "phone")

# The base rules.  Runs are possessive and begin where the run
# before them ended (or at the last match), which finds the same spans without
# trying every character of a long run; possessive groups don't recurse.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_E = r"[^\s@<>(),;:\x22\[\]]"
# What counts as an instance: something around an @, or a run of numbers.
INSTANCE = rf"(?<!{_E}){_E}++@{_E}++|(?<![A-Za-z0-9])[+(]?[0-9][0-9().:\x20/-]*[0-9](?![A-Za-z0-9])"

NEAR = 48               # characters looked at on each side
ROUNDS = 3
LEAST_KNOWN = 3         # known instances that a trusted pattern needs
LEAST_SHARE = 0.8       # and their share of its instances

SPAN = "struct<start:int,end:int>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once (lambdas repeat their text)."""
    return F.transform(F.array(value), body)[0]


def running(lengths: Column, block: int = 256) -> Column:
    """Sums of all elements before each one.  Blocks keep the appended arrays
    short, so a text with very many matches isn't quadratic."""
    def sums(start: Column, xs: Column) -> Column:
        return F.aggregate(xs, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def cut(all_lengths: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_lengths) - 1) / block).cast("int")),
                             lambda b: F.slice(all_lengths, b * block + 1, block))
        return let(blocks, lambda bs: let(
            sums(F.lit(0), F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))),
            lambda starts: F.flatten(F.transform(F.arrays_zip(bs.alias("b"), starts.alias("s")), lambda z: F.when(
                z["b"].isNotNull(), F.slice(sums(z["s"], z["b"]), 1, F.size(z["b"]))).otherwise(
                F.expr("cast(array() as array<int>)"))))))

    return let(lengths, cut)


def matches(text: Column, pattern: str, gate: Column) -> Column:
    """start, end (code points, exclusive), hit, left and right (up to NEAR
    characters around it) of all matches; texts that fail ``gate`` have none.

    Pieces between matches (split) and the matches alternate, so the sums of
    their lengths give the positions."""
    kind = "array<struct<start:int,end:int,hit:string,left:string,right:string>>"

    def placed(gaps: Column, hits: Column) -> Column:
        lengths = F.flatten(F.zip_with(gaps, hits, lambda g, h: F.array(F.length(g), F.coalesce(F.length(h), F.lit(0)))))
        return let(running(lengths), lambda at: F.transform(
            F.arrays_zip(hits.alias("hit"), gaps.alias("left"), F.slice(gaps, 2, F.size(hits)).alias("right")),
            lambda z, i: F.struct(F.get(at, i * 2 + 1).alias("start"), (F.get(at, i * 2 + 1) + F.length(z["hit"])).alias("end"),
                                  z["hit"].alias("hit"), F.right(z["left"], F.lit(NEAR)).alias("left"),
                                  F.left(z["right"], F.lit(NEAR)).alias("right"))))

    found = let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")),
                lambda s: placed(s["gaps"], s["hits"]))
    found = F.filter(found, lambda m: m["hit"].isNotNull())
    return F.when(gate & F.regexp_like(text, F.lit(pattern)), found).otherwise(F.expr(f"cast(array() as {kind})")).cast(kind)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether up to 19 digits pass the Luhn check."""
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (i % 2 + 1)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def counts(kind: str, hit: Column) -> Column:
    """Whether a match of the base pattern of ``kind`` stays."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.regexp_like(hit, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    if kind == "card":
        return let(digits(hit), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    return F.length(digits(hit)).between(9, 15)


def base_spans(text: Column, kind: str) -> Column:
    gate = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(
        kind, F.regexp_like(text, F.lit("[0-9]")))
    kept = F.filter(matches(text, BASE[kind], gate), lambda m: counts(kind, m["hit"]))
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))


def _seed(hit: Column) -> Column:
    """Kind of a well-formed instance, else null."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(F.regexp_like(hit, F.lit(f"^(?:{BASE[kind]})$")) & counts(kind, hit), F.lit(kind)).otherwise(out)
    return out


def _malformed(hit: Column) -> Column:
    """Kind that an instance resembles without being well formed, else null."""
    n = F.length(digits(hit))
    return (F.when(F.contains(hit, F.lit("@")), F.lit("email"))
            .when(F.regexp_like(hit, F.lit(r"^[0-9]++(?:\.[0-9]++){3,}+$")), F.lit("ip"))
            .when(F.regexp_like(hit, F.lit(r"^[0-9\x20-]++$")) & n.between(12, 19), F.lit("card"))
            .when(F.regexp_like(hit, F.lit(r"^[+(]?[0-9\x20().-]++$")) & n.between(7, 15), F.lit("phone")))


def _patterns(left: Column, right: Column) -> Column:
    """The lexical patterns of a context, words in lower case."""
    def words(s: Column) -> Column:
        return F.filter(F.split(F.lower(s), r"\s+"), lambda w: w != "")

    def made(w: Column) -> Column:
        one = F.coalesce(F.try_element_at(w["before"], F.lit(-1)), F.lit("^"))
        two = F.coalesce(F.try_element_at(w["before"], F.lit(-2)), F.lit("^"))
        after = F.coalesce(F.try_element_at(w["after"], F.lit(1)), F.lit("$"))
        return F.array(F.concat_ws(" ", one, F.lit("_")), F.concat_ws(" ", two, one, F.lit("_")),
                       F.concat_ws(" ", one, F.lit("_"), after))

    return let(F.struct(words(left).alias("before"), words(right).alias("after")), made)


def _instances(text: Column) -> Column:
    found = matches(text, INSTANCE, F.regexp_like(text, F.lit("[0-9@]")))
    judged = F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lower(m["hit"]).alias("inst"), _seed(m["hit"]).alias("seed"),
        _malformed(m["hit"]).alias("loose"), _patterns(m["left"], m["right"]).alias("pats")))
    return F.transform(judged, lambda m: m.withField("loose", F.when(m["seed"].isNull(), m["loose"])))


def prepared(df: DataFrame, carry: list[str], text_col: str) -> DataFrame:
    """(row, rid, one base span array per kind, instances), written: texts are
    read once, and ids given on the way stay."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    rows = packed(df, carry, text=text).withColumn("rid", F.monotonically_increasing_id())
    return written(rows.select("row", "rid", *[base_spans(F.col("text"), k).alias(k) for k in KINDS],
                               _instances(F.col("text")).alias("instances")))


def votes(rows: DataFrame) -> DataFrame:
    """(pat, inst, seed, loose): the graph, each edge once.  Edges collapse
    before the shuffle, so a copied passage costs a few rows a task."""
    hits = rows.select(F.explode("instances").alias("m"))
    return (hits.select(F.explode("m.pats").alias("pat"), "m.inst", "m.seed", "m.loose")
            .groupBy("pat", "inst", "seed", "loose").agg(F.count(F.lit(1)).alias("_n")).drop("_n"))


def trusted(edges: DataFrame, accepted: DataFrame | None, least_known: float = LEAST_KNOWN,
            least_share: float = LEAST_SHARE) -> DataFrame:
    """(pat, loose, share): patterns with enough known instances of one kind,
    making up enough of all their instances."""
    if accepted is None:
        scored = edges.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = salted_join(edges, accepted.select("inst", "score"), ["inst"], F.xxhash64("pat"))
    known = [F.sum(F.when(F.col("seed") == k, F.lit(1.0)).when(F.col("loose") == k, F.coalesce("score", F.lit(0.0)))
                   .otherwise(F.lit(0.0))).alias(k) for k in KINDS]
    per_pattern = scored.groupBy("pat").agg(F.count(F.lit(1)).alias("n"), *known)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("loose"), F.col(k).alias("known")) for k in KINDS]))
    return (per_pattern.select("pat", "n", each.alias("k")).select("pat", "k.loose", "k.known", (F.col("k.known") / F.col("n")).alias("share"))
            .filter((F.col("known") >= least_known) & (F.col("share") >= least_share)).select("pat", "loose", "share"))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, least_known: float = LEAST_KNOWN,
              least_share: float = LEAST_SHARE) -> DataFrame:
    """(inst, loose, score): malformed instances in trusted patterns of their
    kind, scored by the best of them.  Scores only rise from round to round."""
    open_edges, accepted = edges.filter("loose is not null"), None
    for _ in range(rounds):
        good = trusted(edges, accepted, least_known, least_share)
        met = salted_join(open_edges, good, ["pat", "loose"], F.xxhash64("inst"), "inner")
        accepted = written(met.groupBy("inst", "loose").agg(F.max("share").alias("score")))
    return accepted


def find(df: DataFrame, carry: list[str] | None = None, text_col: str = "text", rounds: int = ROUNDS,
         least_known: float = LEAST_KNOWN, least_share: float = LEAST_SHARE) -> DataFrame:
    """``carry`` columns (default: all) plus, for each kind, ``<kind>_spans``
    (base spans) and ``found`` (kind, start, end, score of the spans added by
    context; they overlap no base span).

    Null texts count as empty; empty texts have no spans.  Whole texts are
    read, however long.  Repeated rows each get their spans, but an instance
    votes once for a pattern however often it stands there.  An empty table
    gives an empty result.  Carried columns named like an added one are
    replaced.
    """
    carry = list(carry or df.columns)
    rows = prepared(df, carry, text_col)
    accepted = bootstrap(written(votes(rows)), rounds, least_known, least_share)
    places = (rows.select("rid", F.explode("instances").alias("m")).select("rid", "m.start", "m.end", "m.inst", "m.loose")
              .filter("loose is not null"))
    met = salted_join(places, accepted.select("inst", "score"), ["inst"], F.col("rid"), "inner")
    added = met.groupBy(F.col("rid").alias("of")).agg(F.array_sort(F.collect_list(
        F.struct("start", "end", F.col("loose").alias("kind"), "score"))).alias("added"))
    joined = rows.drop("instances").join(added, F.col("rid") == F.col("of"), "left")
    base = F.concat(*KINDS)
    free = F.filter("added", lambda a: ~F.exists(base, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:string,score:double>>)")
    return unpacked(joined, carry, **{f"{k}_spans": F.col(k) for k in KINDS}, found=F.coalesce(free, none))


def joined_spans(with_found: bool) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    def said(kind: Column, place: Column, s: Column) -> Column:
        return F.struct(s["start"].alias("start"), place.alias("place"),
                        F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string")).alias("said"))

    def of_kind(place: int, kind: str) -> Column:
        return F.transform(f"{kind}_spans", lambda s: said(F.lit(kind), F.lit(place), s))

    every = [of_kind(i, k) for i, k in enumerate(KINDS)]
    if with_found:
        order = F.array(*map(F.lit, KINDS))
        every.append(F.transform("found", lambda s: said(s["kind"], (F.array_position(order, s["kind"]) - 1).cast("int"), s)))
    return F.array_join(F.transform(F.array_sort(F.concat(*every)), lambda s: s["said"]), ",")
