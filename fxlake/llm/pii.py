"""Personal data: base patterns, and boosted trees over candidate spans.

High-recall generators propose overlapping candidates. The trees learn from
planted examples: values of each kind in plain and disguised forms
(``PLANTED``), and numbers, dates, versions, prose and mistyped values that
are none (``DECOYS``), set between words of a bounded sample of the documents
(in hash order), some of them two together. A candidate that covers a planted value exactly,
by its own kind, is a positive example; any other candidate of these texts is a negative
one. So labels come from how an example was made and not from the base checks.
The trees use format features (counts and sizes of digit groups, separators,
the Luhn sum) and context features (neighbours, cue words); each kind has trees of its own
and a threshold set on the held-out quarter for ``PRECISION``. The fitted trees are written
out as SQL expressions, so scoring is one projection over the documents: no
shuffle, no Python on the executors.

Cases: null and empty texts hold nothing; without any row to take words from
only base spans are returned; repeated rows are answered each; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from fxlake.llm.spans import joined, keep, matches, quoted
from fxlake.session import stage_table

KINDS = ("email", "ip", "card", "phone")
# The same matches as the plain patterns, begun only where a match can begin: at a run's start or after the last match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Generators: kind and pattern.
GENERATORS = [
    ("email", r"[A-Za-z0-9._%+-]{1,64}(?:@|\x20?(?:\[at\]|\(at\))\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?(?:\[dot\]|\(dot\))\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}){1,6}",
     r"(contains(text, '@') OR contains(text, '[at]') OR contains(text, '(at)') OR contains(text, ' at ') AND text RLIKE ' at [A-Za-z0-9-]+(\\.| ?[\\[(]?dot)')"),
    ("ip", r"(?<![0-9])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9])", r"text RLIKE '[0-9]\\.[0-9]'"),
    ("ip", r"(?<![0-9])[0-9]{1,3}(?:\x20?[\[(]?(?:\.|dot)[\])]?\x20?[0-9]{1,3}){3}(?![0-9])", r"text RLIKE '[0-9] ?[\\[(]?([.]|dot)[\\])]? ?[0-9]'"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{4}){3}(?:[0-9]{0,3})(?![0-9])", "text RLIKE '[0-9]{4}'"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,3}(?![0-9])", "contains(text, '+')"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){2}(?![0-9])", "contains(text, '+')"),
    ("phone", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "text RLIKE '[0-9]{3}'"),
    ("phone", r"(?<![0-9+])0[0-9]{2,5}[\x20.-][0-9]{3,4}(?:[\x20.-]?[0-9]{3,4}){1,2}(?![0-9])", "text RLIKE '0[0-9]{2}'"),
    ("phone", r"(?<![0-9])[0-9]{5,19}(?![0-9])", "text RLIKE '[0-9]{5}'"),
]
SAMPLE = 500
TREES, DEPTH, STEP, SEED = 12, 4, 0.3, 7
PRECISION = 0.98
CONTEXT = 24

FEATURES = {
    "digits": "length(regexp_replace(c.hit, '[^0-9]', ''))",
    "letters": "length(regexp_replace(c.hit, '[^A-Za-z]', ''))",
    "size": "length(c.hit)",
    "groups": "size(split(c.hit, '[^0-9A-Za-z]+'))",
    "plus": "int(startswith(c.hit, '+'))",
    "brackets": "int(contains(c.hit, '('))",
    "dots": "length(c.hit) - length(replace(c.hit, '.', ''))",
    "hyphens": "length(c.hit) - length(replace(c.hit, '-', ''))",
    "blanks": "length(c.hit) - length(replace(c.hit, ' ', ''))",
    "at": "int(contains(c.hit, '@'))",
    "first": "ascii(c.hit)",
    "widest": "array_max(transform(split(c.hit, '[^0-9]+'), g -> length(g)))",
    "narrowest": "array_min(transform(split(c.hit, '[^0-9]+'), g -> length(g)))",
    "largest": "coalesce(array_max(transform(filter(split(c.hit, '[^0-9]+'), g -> length(g) BETWEEN 1 AND 4), g -> int(g))), 0)",
    "luhn": None,  # set below
    "before": "ascii(substr(c.before, -1))",
    "after": "ascii(c.after)",
    "plus_before": "int(c.before RLIKE '[+][0-9]{1,3}[ .-]?$')",
    "phone_cue": "int(c.before RLIKE '(?i)phone|tel|call|fax|mobile')",
    "card_cue": "int(c.before RLIKE '(?i)card|visa|pay|account')",
    "mail_cue": "int(c.before RLIKE '(?i)mail|contact|write')",
    "ip_cue": r"int(c.before RLIKE '(?i)\\bip\\b|host|server|address')",
    "other_cue": r"int(c.before RLIKE '(?i)\\b(id|order|ref|no|isbn|serial|invoice|part|total|version|build|release|section|page|date|batch)\\b')",
    "domain": r"int(c.hit RLIKE '[^A-Za-z](com|org|net|edu|info|io|de|fr|es|uk)$')",
    "ends_in_digit": "int(c.hit RLIKE '[0-9]$')",
    "disguised": r"int(c.hit RLIKE '[\\[(](at|dot|[.])[\\])]| dot ')",
}


def _number(size: int, part: int) -> str:
    """SQL for ``size`` seeded digits of the example ``x``."""
    return f"lpad(string(pmod(xxhash64(x.h, {part}), {10 ** size}L)), {size}, '0')"


def _below(bound: int, part: int, least: int = 0) -> str:
    return f"string({least} + pmod(xxhash64(x.h, {part}), {bound - least}L))"


def _octets(between: str, bound: int = 256, least: int = 0) -> str:
    return f"concat_ws('{between}', {_below(bound, 1, least)}, {_below(256, 2)}, {_below(256, 3)}, {_below(256, 4)})"


def _luhn(digits: str) -> str:
    """SQL for the Luhn check of a string of 1 or more digits."""
    return f"""aggregate(sequence(1, length({digits})), 0, (acc, i) -> acc + CASE WHEN i % 2 = 1 THEN int(substr(reverse({digits}), i, 1))
        ELSE int(substr('0246813579', int(substr(reverse({digits}), i, 1)) + 1, 1)) END) % 10 = 0"""


def _digits(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


FEATURES["luhn"] = f"int(CASE WHEN length({_digits('c.hit')}) BETWEEN 12 AND 19 THEN {_luhn(_digits('c.hit'))} ELSE false END)"


def _valid(kind: str, hit: str) -> str:
    """SQL for the checks of a kind."""
    if kind == "email":
        return "true"
    if kind == "ip":
        return f"{hit} RLIKE {quoted('^' + OCTET + (r'\.' + OCTET) * 3 + '$')}"
    d = _digits(hit)
    if kind == "card":
        return f"CASE WHEN length({d}) BETWEEN 16 AND 19 THEN {_luhn(d)} ELSE false END"
    return f"length({d}) BETWEEN 8 AND 15"


def _base(text: str) -> dict[str, str]:
    when = {"email": f"contains({text}, '@')", "ip": rf"{text} RLIKE '[0-9]\\.[0-9]+\\.[0-9]'",
            "card": rf"{text} RLIKE '[0-9](?:[ -]?[0-9]){{15}}'", "phone": f"contains({text}, '+')"}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    return {k: keep(matches(text, patterns[k], when[k]), _valid(k, "x.hit")) for k in KINDS}


def with_base(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = documents.select(F.col(id_col).alias("doc"), F.coalesce(text_col, F.lit("")).alias("text"))
    return body.select("doc", "text", *[F.expr(sql).alias(k) for k, sql in _base("text").items()])


def with_candidates(base: DataFrame) -> DataFrame:
    """Adds ``candidates``: spans with their kind, context and features."""
    cut = f"substr(text, greatest(1, x.start + 1 - {CONTEXT}), least(x.start, {CONTEXT}))"
    proposed = "concat(%s)" % ", ".join(
        f"transform({matches('text', p, when)}, x -> named_struct('kind', '{kind}', 'start', x.start, 'end', x.end, 'hit', x.hit, "
        f"'before', {cut}, 'after', substr(text, x.end + 1, 1)))" for kind, p, when in GENERATORS)
    features = ", ".join(f"double({sql})" for sql in FEATURES.values())
    return (base.withColumn("raw", F.expr(proposed))
            .withColumn("candidates", F.expr(f"transform(raw, c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'hit', c.hit, 'f', array({features})))"))
            .drop("raw"))


_CARD = (f"element_at(transform(array({_number(15, 1)}), d -> element_at(filter(transform(sequence(0, 9), c -> concat(d, string(c))), "
         f"y -> {_luhn('y')}), 1)), 1)")
_WRONG = (f"element_at(transform(array({_number(15, 1)}), d -> element_at(filter(transform(sequence(0, 9), c -> concat(d, string(c))), "
          f"y -> NOT ({_luhn('y')})), 1 + int(pmod(x.h, 9L)))), 1)")
_MAIL = "concat_ws('{0}', concat(x.a, element_at(array('', '.', '_', '-'), 1 + int(pmod(xxhash64(x.h, 8), 4L))), {1}), concat_ws('{2}', CASE WHEN pmod(xxhash64(x.h, 9), 3L) = 0 THEN concat(x.b, '-', x.a) ELSE x.b END, element_at(array('com', 'org', 'net', 'de', 'example.com', 'co.uk'), 1 + int(pmod(x.h, 6L)))))"


def _mail(at: str, dot: str) -> str:
    return _MAIL.format(at, _number(2, 1), dot)


def _fours(value: str, between: str) -> str:
    return f"regexp_replace({value}, '([0-9]{{4}})(?=[0-9])', '$1{between}')"


# Cue words per kind, one of which or none stands before a value.
CUES = {"email": ["mail", "contact", "write to"], "ip": ["ip", "host", "server", "address"], "card": ["card", "visa", "paid by", "account"],
        "phone": ["call", "phone", "tel", "fax", "mobile"], "": ["id", "order", "ref", "no", "isbn", "serial", "invoice", "part", "total", "version", "build", "section"]}
# Values by kind, and whether a cue word always comes first.
PLANTED = [
    *[("email", _mail(at, dot), False) for at, dot in (("@", "."), (" [at] ", " [dot] "), ("[at]", " [dot] "), ("[at]", "."), ("(at)", "(dot)"), ("(at)", "."), (" [at] ", "."), (" (at) ", "."), (" at ", " dot "), (" at ", "."))],
    *[("ip", _octets(between), False) for between in (".", "[.]", "(.)", " dot ", "[dot]")],
    ("card", _CARD, False), *[("card", _fours(_CARD, between), False) for between in (" ", "-", ".")],
    ("phone", f"concat('+1 (', {_number(3, 1)}, ') ', {_number(3, 2)}, '-', {_number(4, 3)})", False),
    ("phone", f"concat('+', {_below(99, 1, 20)}, ' ', {_number(2, 2)}, ' ', {_number(4, 3)}, ' ', {_number(4, 4)})", False),
    ("phone", f"concat('(', {_number(3, 1)}, ') ', {_number(3, 2)}, '-', {_number(4, 3)})", False),
    *[("phone", f"concat_ws('{between}', {_below(999, 1, 200)}, {_number(3, 2)}, {_number(4, 3)})", False) for between in ("-", ".", " ")],
    ("phone", f"concat('0', {_number(2, 1)}, ' ', {_number(4, 2)}, ' ', {_number(4, 3)})", False),
    ("phone", f"concat('0', {_number(3, 1)}, ' ', {_number(3, 2)}, ' ', {_number(4, 3)})", False),
    ("phone", f"concat('00', {_below(99, 1, 20)}, ' ', {_number(3, 2)}, ' ', {_number(4, 3)})", False),
    ("phone", _number(10, 1), True),
]
DECOYS = [
    "concat_ws(' ', x.a, 'at', concat_ws('.', x.b, x.a))", f"concat(x.a, ' at ', {_below(24, 1)}, '.', {_number(2, 2)})",
    f"concat(x.a, ' at ', concat_ws('.', {_number(1, 1)}, {_number(1, 2)}, {_number(1, 3)}))", f"concat(x.b, ' at ', {_number(3, 1)}, '.', {_number(2, 2)})",
    "concat(x.a, ' (at) ', x.b, '.', x.a)",
    _octets(".", 999, 256), _octets("[.]", 999, 256), f"concat_ws('. ', {_below(9, 1, 1)}, {_below(9, 2, 1)}, {_below(9, 3, 1)}, {_below(9, 4, 1)})",
    f"concat_ws('.', {_below(20, 1)}, {_below(20, 2)}, {_below(9999, 3, 1000)}, {_below(9, 4)})",
    _WRONG, _fours(_WRONG, " "), _fours(_WRONG, "-"), _fours(_WRONG, "."), _number(16, 1), _number(18, 1),
    *[_number(size, 1) for size in (5, 6, 8, 10, 11, 13)], f"concat_ws('-', {_below(2030, 1, 1990)}, {_number(2, 2)}, {_number(2, 3)})",
    f"concat_ws('-', {_number(3, 1)}, {_number(3, 2)}, {_number(4, 3)})", f"concat_ws(' ', {_number(3, 1)}, {_number(3, 2)}, {_number(4, 3)})",
    f"concat_ws('.', {_number(3, 1)}, {_number(3, 2)}, {_number(4, 3)})", f"concat('978-', {_number(1, 1)}, '-', {_number(4, 2)}, '-', {_number(4, 3)})",
    f"concat('0', {_number(3, 1)}, '-', {_number(3, 2)}, '-', {_number(3, 3)})", f"concat('+', {_number(5, 1)})",
]
# Decoys that look like phones have a cue that says what they are.
_FORMS = [*PLANTED, *[("", sql, i >= len(DECOYS) - 6) for i, sql in enumerate(DECOYS)]]


def planted(documents: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE) -> DataFrame:
    """(doc, text, plants, held): each form between words of at most ``sample`` documents; a third hold a second value, some right behind the first."""
    n = len(_FORMS)
    words = "filter(split(regexp_replace(coalesce({0}, ''), '[0-9@+]+', ''), '[ \\t\\n\\r]+'), w -> w <> '')".format(f"`{text_col}`")
    picked = (documents.select(F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h0"), F.expr(words).alias("w"))
              .select("h0", F.expr("slice(w, 1 + int(pmod(h0, greatest(size(w) - 12, 1))), 12)").alias("w"))
              .orderBy("h0", "w").limit(sample))
    case = lambda values: "CASE x.n " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"
    plain = "coalesce(nullif(lower(regexp_replace(get(w, {0}), '[^A-Za-z]', '')), ''), '{1}')"
    cue = case("CASE WHEN {} THEN element_at(array({}), 1 + int(pmod(xxhash64(x.h, 0), {}L))) ELSE '' END".format(
        "true" if always else "pmod(x.h, 2) = 0", ", ".join(f"'{c}'" for c in CUES[kind]), len(CUES[kind])) for kind, _, always in _FORMS)
    item = lambda text, kind="''", tail="''": f"named_struct('kind', {kind}, 'text', {text}, 'tail', {tail})"
    rows = (picked.select("h0", "w", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("n"))
            .withColumn("h", F.xxhash64("h0", "n"))
            .withColumn("a", F.expr(f"concat({plain.format('size(w) - 1', 'ann')}, '')")).withColumn("b", F.expr(f"concat({plain.format('0', 'site')}, 'er')"))
            .withColumn("values", F.expr(f"""transform(filter(array(named_struct('n', n, 'h', h, 'a', a, 'b', b),
                named_struct('n', int(pmod(xxhash64(h, 2), {n}L)), 'h', xxhash64(h, 3), 'a', a, 'b', b)), (x, i) -> i = 0 OR pmod(h, 3) = 0),
                x -> named_struct('kind', {case(f"'{kind}'" for kind, _, _ in _FORMS)}, 'cue', {cue}, 'value', {case(sql for _, sql, _ in _FORMS)},
                    'tail', element_at(array('', '', ',', '.', ';'), 1 + int(pmod(xxhash64(x.h, 5), 5L)))))""")))
    middle = "CASE WHEN pmod(h, 2) = 0 THEN array_join(slice(w, 5, 4), ' ') ELSE '' END"
    first, second = "element_at(values, 1)", "get(values, 1)"
    items = ", ".join([item("array_join(slice(w, 1, 4), ' ')"), item(f"{first}.cue"), item(f"{first}.value", f"{first}.kind", f"CASE WHEN size(values) = 2 AND pmod(h, 2) <> 0 THEN '' ELSE {first}.tail END"),
                       item(middle), item(f"CASE WHEN pmod(h, 2) = 0 THEN {second}.cue END"), item(f"{second}.value", f"{second}.kind", f"{second}.tail"),
                       item("array_join(slice(w, 9, 4), ' ')")])
    return (rows.withColumn("items", F.expr(f"filter(array({items}), i -> coalesce(i.text, '') <> '')"))
            .select(F.col("h").alias("doc"), F.expr("array_join(transform(items, i -> concat(i.text, i.tail)), ' ')").alias("text"),
                    F.expr("""aggregate(items, named_struct('at', 0, 'found', cast(array() AS array<struct<kind:string,start:int,end:int>>)),
                        (acc, i) -> named_struct('at', acc.at + length(i.text) + length(i.tail) + 1, 'found', CASE WHEN i.kind = '' THEN acc.found ELSE concat(acc.found,
                            array(named_struct('kind', i.kind, 'start', acc.at, 'end', acc.at + length(i.text)))) END), acc -> acc.found)""").alias("plants"),
                    (F.pmod("h0", F.lit(4)) == 0).alias("held")))


def examples(plants: DataFrame) -> DataFrame:
    """(kind, f, label, held) of every candidate in the planted texts."""
    exact = "exists(plants, y -> y.kind = c.kind AND y.start = c.start AND y.end = c.end)"
    return (with_candidates(plants)
            .select("held", F.explode(F.expr(f"transform(candidates, c -> named_struct('kind', c.kind, 'f', c.f, 'label', CASE WHEN {exact} THEN 1.0D ELSE 0.0D END))")).alias("c"))
            .select("c.kind", "c.f", "c.label", "held"))


def _tree_sql(node) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    split = node.split()
    return (f"CASE WHEN c.f[{split.featureIndex()}] <= {split.threshold()!r}D THEN {_tree_sql(node.leftChild())} "
            f"ELSE {_tree_sql(node.rightChild())} END")


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[str, dict[str, float]] | None:
    """The boosted margin as SQL over ``c.f``, and the least margin to accept per kind; None without both sorts of examples."""
    # At most ``sample`` documents times the forms, a few words each.
    plants = stage_table(planted(documents, id_col, text_col, sample), "pii-plants").repartition(8)
    rows = stage_table(examples(plants), "pii-examples")
    margins, limits = {}, {}
    for kind in KINDS:
        own = rows.where(F.col("kind") == kind)
        fit = own.where("NOT held")
        if fit.select("label").distinct().count() < 2:
            continue
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, featuresCol="x", labelCol="label", cacheNodeIds=False).fit(
            fit.select(array_to_vector("f").alias("x"), "label"))
        margin = " + ".join(f"{w!r}D * ({_tree_sql(t._java_obj.rootNode())})" for t, w in zip(model.trees, model.treeWeights))
        # At most the held-out part of the sample. Both sorts weigh the same, however many were made.
        steps = (own.where("held").select("label", F.expr(f"element_at(transform(array(named_struct('f', f)), c -> {margin}), 1)").alias("m"))
                 .groupBy("m").agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).orderBy(F.desc("m")).collect())
        all_good, all_bad = sum(r.good for r in steps), sum(r.bad for r in steps)
        good = bad = 0
        for r in steps:
            good, bad = good + r.good, bad + r.bad
            if good * all_bad >= PRECISION * (good * all_bad + bad * all_good) and r.m > 0:
                margins[kind], limits[kind] = margin, r.m
    return ("CASE c.kind " + " ".join(f"WHEN '{k}' THEN {m}" for k, m in margins.items()) + " END", limits) if limits else None


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Per row: doc, counts of base spans, base (string), spans (string), found (array of kind, start, end)."""
    base = with_base(documents, id_col, text_col)
    model = train(documents, id_col, text_col, sample)
    return apply(base, model)


def apply(base: DataFrame, model: tuple[str, dict[str, float]] | None) -> DataFrame:
    if model is None or not model[1]:
        df = base.withColumn("extra", F.expr("cast(array() AS array<struct<kind:string,start:int,end:int>>)"))
    else:
        margin, limits = model
        least = "CASE c.kind " + " ".join(f"WHEN '{k}' THEN {v!r}D" for k, v in limits.items()) + " END"
        free = "NOT exists(concat(email, ip, card, phone), y -> y.start < c.end AND c.start < y.end)"
        df = (with_candidates(base)
              .withColumn("open", F.expr(f"filter(candidates, c -> {free})"))
              .withColumn("scored", F.expr(f"transform(open, c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'm', {margin}))"))
              .withColumn("taken", F.expr(f"filter(scored, c -> coalesce(c.m >= {least}, false))"))
              # Of overlapping candidates the surest stays, then the longest, then the first.
              .withColumn("extra", F.expr("""transform(filter(taken, c -> NOT exists(taken, y -> y.start < c.end AND c.start < y.end
                  AND (y.m > c.m OR y.m = c.m AND (y.end - y.start > c.end - c.start OR y.end - y.start = c.end - c.start
                       AND (y.start < c.start OR y.start = c.start AND y.kind < c.kind))))),
                  c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end))""")))
    plain = ", ".join(f"transform({k}, x -> named_struct('kind', '{k}', 'start', x.start, 'end', x.end))" for k in KINDS)
    every = ", ".join(f"array_sort(concat(transform({k}, x -> named_struct('start', x.start, 'end', x.end, 'kind', '{k}')), "
                      f"transform(filter(extra, e -> e.kind = '{k}'), e -> named_struct('start', e.start, 'end', e.end, 'kind', '{k}'))))" for k in KINDS)
    return (df.select("doc", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.expr(f"concat({plain})").alias("plain"),
                      F.expr(f"array_distinct(concat({every}))").alias("found"))
            .select("*", F.expr(joined("plain")).alias("base"), F.expr(joined("found")).alias("spans")).drop("plain"))
