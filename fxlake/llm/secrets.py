"""Secret scans: base patterns, and two character Markov models compared by log-likelihood ratio.

One model is trained on random strings (the values that the base patterns find,
and seeded hexadecimal, base-36 and base-64 strings), one on ordinary
identifiers (long words, and compounds of the documents' own words: snake and
camel case, constants with a value, paths, dated names, numbers). Both
come from a bounded labelled sample in hash order. The models learn from three
quarters of the strings. On the last quarter the threshold is set: the mean
log-ratio per character pair that ``1 - FALSE_RATE`` of the ordinary strings stay
under, or the middle between that and the lowest ``MISS_RATE`` of the random
ones where the two do not meet. A token of ``MIN_LENGTH`` characters or more
above it becomes a span; UUIDs and tokens of fewer than ``MIN_DISTINCT``
different characters (rulers) never do. Training counts, positions and scores
are built-in functions; the model is a table of 128 x 128 numbers.

Cases: null and empty texts hold nothing; without random strings in the sample
only base spans are returned; repeated rows are answered each; an empty table
gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from fxlake.llm.spans import joined, keep, matches, quoted
from fxlake.session import stage_table

VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = f"{ASSIGN_HEAD}{VALUE}++"
ASSIGN_VALUE = f"^{ASSIGN_HEAD}({VALUE}+)"
ACCESS = "AKIA[A-Z0-9]{14,}+"
HEX = "[0-9a-f]{16,}+"
MIN_VALUE, MIN_LENGTH, MIN_DISTINCT = 12, 16, 6
TOKEN = "[A-Za-z0-9+/_=-]{%d,}+" % MIN_LENGTH
ORDINARY = "(?<![A-Za-z0-9+/_=.-])[A-Za-z_]{8,}+(?![A-Za-z0-9+/_=-])"
WORD = "(?<![A-Za-z0-9+/_=.-])[A-Za-z]{3,12}+(?![A-Za-z0-9+/_=-])"
UUID = "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
KINDS = ("assign", "access", "hex", "random")

SAMPLE_DOCS = 2000
SAMPLE_STRINGS = 20000
SMOOTHING = 0.5
FALSE_RATE = 0.001
MISS_RATE = 0.02
HELD_PART = 4
ALPHABET = 64 + 4

# Compounds of three words a, b, c and a number h, and random strings of a seed h.
COMPOUNDS = ["concat_ws('_', a, b, c)", "concat(upper(concat_ws('_', a, b, c)), '=', h % 10000)", "concat_ws('/', a, b, initcap(c))",
             "concat(lower(a), initcap(b), initcap(c))", "concat_ws('-', a, b, c, h % 1000)", "concat('/', a, '/', b, '/', c, h % 100)",
             "concat(a, '_', 1990 + h % 50, '-', lpad(1 + h % 12, 2, '0'), '-', lpad(1 + h % 28, 2, '0'), '_', b)",
             "concat(a, '=', b, h % 100, '/', c)", "concat(initcap(a), initcap(b), initcap(c), h % 10)",
             "lpad(h, 19, '1234567890')", "concat(a, '+', b, '+', c)"]
RANDOMS = ["substr(sha2(string(h), 256), 1, int(16 + h % 32))", "replace(base64(unhex(sha2(string(h), 256))), '=', '')",
           "replace(replace(replace(base64(unhex(sha2(string(h), 384))), '+', ''), '/', ''), '=', '')",
           "concat(conv(substr(sha2(string(h), 256), 1, 15), 16, 36), conv(substr(sha2(string(h), 256), 17, 15), 16, 36))"]

_CUES = "password|passwd|secret|token|apikey|api_key".split("|")


def _base(text: str) -> dict[str, str]:
    """SQL for the base spans of each kind."""
    cue = " OR ".join(f"contains(lower({text}), '{c}')" for c in _CUES)
    long_value = f"length(regexp_extract(x.hit, {quoted(ASSIGN_VALUE)}, 1)) >= {MIN_VALUE}"
    return {"assign": keep(matches(text, ASSIGN, cue), long_value),
            "access": matches(text, ACCESS, f"contains({text}, 'AKIA')"),
            "hex": matches(text, HEX, f"{text} RLIKE {quoted(HEX)}")}


def _pairs(strings: DataFrame) -> DataFrame:
    """Counts of adjacent characters of ASCII strings, by ``random``."""
    steps = "transform(sequence(1, length(s) - 1), i -> ascii(substr(s, i, 1)) * 128 + ascii(substr(s, i + 1, 1)))"
    return (strings.where("length(s) > 1").select("random", F.explode(F.expr(steps)).alias("pair"))
            .groupBy("random", "pair").agg(F.count("*").alias("n")))


def _chosen(forms: list[str]) -> str:
    return "CASE h % " + str(len(forms)) + "".join(f" WHEN {k} THEN {f}" for k, f in enumerate(forms)) + " END"


def labelled(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", docs: int = SAMPLE_DOCS,
             strings: int = SAMPLE_STRINGS) -> DataFrame:
    """(s, random, held): random strings and ordinary ones, from at most ``docs`` texts of each sort and ``strings`` of each sort."""
    body = documents.select(F.coalesce(text_col, F.lit("")).alias("text"), F.xxhash64(F.lit("sample"), id_col, text_col).alias("order"))
    values = F.expr(f"""concat(transform(assign, x -> regexp_extract(x.hit, {quoted(ASSIGN_VALUE)}, 1)),
                               transform(access, x -> x.hit), transform(hex, x -> x.hit))""")
    found = (body.select("order", *[F.expr(sql).alias(k) for k, sql in _base("text").items()])
             .select("order", values.alias("values")).where("size(values) > 0").orderBy("order").limit(docs))
    found = stage_table(found, "secret-values")
    seeded = found.select(F.explode(F.expr("transform(sequence(0, 7), k -> xxhash64(order, k) & 9223372036854775807)")).alias("h"))
    random = (found.select(F.explode("values").alias("s")).unionByName(seeded.select(F.expr(_chosen(RANDOMS)).alias("s")))
              .withColumn("random", F.lit(True)))
    # The hashes alone are sorted; the texts of the sample are read by the place of the last one.
    last = body.select("order").orderBy("order").limit(docs).agg(F.max("order")).first()[0]
    texts = body.where(F.col("order") <= F.lit(last).cast("long"))
    long_words = texts.select(F.explode(F.expr(f"regexp_extract_all(text, {quoted(ORDINARY)}, 0)")).alias("s"))
    triples = (texts.select(F.expr(f"regexp_extract_all(text, {quoted(WORD)}, 0)").alias("w")).where("size(w) > 2")
               .select(F.explode(F.expr("transform(sequence(0, size(w) - 3), i -> named_struct('a', w[i], 'b', w[i + 1], 'c', w[i + 2]))")).alias("t"))
               .select("t.*", F.expr("xxhash64(t.a, t.b, t.c) & 9223372036854775807").alias("h")))
    compounds = triples.select(F.expr(_chosen(COMPOUNDS)).alias("s"))
    ordinary = [x.distinct().orderBy(F.xxhash64("s")).limit(strings // 2) for x in (long_words, compounds)]
    both = random.unionByName(ordinary[0].unionByName(ordinary[1]).withColumn("random", F.lit(False)))
    both = both.where(F.col("s").rlike(r"^[\x21-\x7E]+$")).distinct()
    held = (F.pmod(F.xxhash64(F.lit("held"), "s"), F.lit(HELD_PART)) == 0).alias("held")
    return (both.where("random").orderBy(F.xxhash64("s")).limit(strings).unionByName(both.where("NOT random"))
            .select("s", "random", held))


def _score(s: str, table: str) -> str:
    """SQL for the mean log-ratio per pair of an ASCII string."""
    step = f"get({table}, ascii(substr({s}, i, 1)) * 128 + ascii(substr({s}, i + 1, 1)))"
    return f"aggregate(sequence(1, length({s}) - 1), 0.0D, (acc, i) -> acc + {step}) / (length({s}) - 1)"


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_rate: float = FALSE_RATE) -> tuple[str, float] | None:
    """The log-ratio table as a SQL array, and the threshold; None without values that base patterns find."""
    sample = stage_table(labelled(documents, id_col, text_col), "secret-sample")
    counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for random, pair, n in _pairs(sample.where("NOT held")).collect():  # at most 2 * 128 * 128 rows
        counts[random][pair] = n
    if not counts[True]:
        return None
    logs = {}
    for random, seen in counts.items():
        total = [0.0] * 128
        for pair, n in seen.items():
            total[pair >> 7] += n
        logs[random] = [math.log((seen.get(k, 0) + SMOOTHING) / (total[k >> 7] + SMOOTHING * ALPHABET)) for k in range(128 * 128)]
    ratio = ",".join(f"{a - b:.3f}" for a, b in zip(logs[True], logs[False]))
    table = f"cast(split('{ratio}', ',') AS array<double>)"
    scores = sample.where(f"held AND length(s) >= {MIN_LENGTH}").select("random", F.expr(_score("s", table)).alias("score"))
    top, low = scores.agg(F.percentile(F.expr("CASE WHEN NOT random THEN score END"), 1 - false_rate),
                          F.percentile(F.expr("CASE WHEN random THEN score END"), MISS_RATE)).first()
    if top is None:
        return table, max(low or 0.0, 0.0)
    return table, max(top, (top + low) / 2) if low is not None else max(top, 0.0)


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: tuple[str, float] | None = None) -> DataFrame:
    """Per row: doc, n_assign, n_access, n_hex, base (string), spans (string), found (array of kind, start, end)."""
    base = _base("text")
    body = documents.select(F.col(id_col).alias("doc"), F.coalesce(text_col, F.lit("")).alias("text"))
    df = body.select("doc", "text", *[F.expr(sql).alias(k) for k, sql in base.items()])
    none = "cast(array() AS array<struct<start:int,end:int,hit:string>>)"
    df = df.withColumn("all_base", F.expr("concat(assign, access, hex)"))
    if model is None:
        df = df.withColumn("random", F.expr(none))
    else:
        table, limit = model
        df = df.withColumn("tokens", F.expr(matches("text", TOKEN, f"text RLIKE {quoted(TOKEN)}")))
        df = df.withColumn("random", F.expr(
            f"filter(tokens, t -> NOT t.hit RLIKE {quoted(UUID)} AND size(array_distinct(split(t.hit, ''))) >= {MIN_DISTINCT} AND NOT exists(all_base, y -> y.start < t.end AND t.start < y.end) AND {_score('t.hit', table)} > {limit!r}D)"))
    # By start, then by kind in the listed order: sort on (start, rank).
    ranked = "concat(%s)" % ", ".join(
        f"transform({k}, x -> named_struct('start', x.start, 'rank', {r}, 'kind', '{k}', 'end', x.end))" for r, k in enumerate(KINDS))
    return (df.select("doc", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], F.expr(f"array_sort({ranked})").alias("found"))
            .select("*", F.expr(joined("filter(found, x -> x.rank < 3)")).alias("base"), F.expr(joined("found")).alias("spans")))
