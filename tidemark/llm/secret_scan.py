"""Secret scan: three fixed kinds and a battery of randomness tests.

Long unbroken tokens are candidates; of tokens with signs in them, also the parts between signs, so that keys joined by
them are seen. For each the encoding is inferred (hex, base32, base64, letters) and three tests ask whether its symbols
could be uniform draws from that alphabet: chi-squared over symbols and over symbol classes, runs above and below the
middle of the alphabet, and serial correlation. A token that one of them rejects, at a level split over the tests, is no
secret. For the rest, evidence against ordinary writing is the likelihood ratio of uniform symbols to the corpus's own
writing: its frequencies of letter, digit and sign classes and of each letter after another. Tokens of one case are held
against words in one case too, and the weaker evidence counts. Its inverse is a valid p-value at any length (short tokens
can't reach small ones), and the step-up rule of Benjamini and Hochberg over all candidates of the corpus bounds the
share of false discoveries. The step-up threshold is found from counts in bins of evidence. Of spans found within each
other the widest stays.

Defined results: a null or empty text has no spans; repeated rows are scanned each; an empty table gives an empty result;
columns other than the id and text columns are ignored, whatever their names. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import drop, let, recorded, stage, text_sha

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kinds in the order of the contract: (name, pattern, shortest match, group whose length counts).
KINDS = (("assign", _ASSIGN, 6, 2), ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", 24, 0))
RANDOM = ("random", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+", 16, 0)
#: Parts of tokens: base64 between signs of the other kind, base64url likewise, and what stands between any signs.
PARTS = (r"[A-Za-z0-9+/]{16,}+", r"[A-Za-z0-9_-]{16,}+", r"[A-Za-z0-9]{16,}+")

_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings: alphabet in the order of symbol values and the sizes of its classes (upper, lower, digit, sign).
ALPHABETS = {
    "hex_lower": (_DIGIT + "abcdef", (0, 6, 10, 0)),
    "hex_upper": (_DIGIT + "ABCDEF", (6, 0, 10, 0)),
    "upper": (_UPPER, (26, 0, 0, 0)),
    "lower": (_LOWER, (0, 26, 0, 0)),
    "letters": (_UPPER + _LOWER, (26, 26, 0, 0)),
    "base32": (_UPPER + "234567", (26, 0, 6, 0)),
    "base64": (_UPPER + _LOWER + _DIGIT + "+/", (26, 26, 10, 2)),
    "base64url": (_UPPER + _LOWER + _DIGIT + "-_", (26, 26, 10, 2)),
}
CLASSES = ("upper", "lower", "digit", "sign")
_CLASS_SIZE = (26, 26, 10, 4)


def _matches(text: Column, rank: int, pattern: str, group: int) -> Column:
    """Matches as (kind, place in order, code points before since the last match, match, length that counts)."""
    # The rest after the last match is one (empty) match too: without it every place there would be tried as a start.
    whole = F.lit(rf"(?s)\G(.*?)(?:({pattern})|\z)")
    gaps, hits = F.regexp_extract_all(text, whole, F.lit(1)), F.regexp_extract_all(text, whole, F.lit(2))
    counted = (lambda hit: F.length(F.regexp_extract(hit, pattern, group))) if group else F.length
    rows = F.transform(
        F.arrays_zip(gaps.alias("gap"), hits.alias("hit")),
        lambda x, i: F.struct(F.lit(rank).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["hit"].alias("hit"), counted(x["hit"]).alias("n")),
    )
    rows = F.filter(rows, lambda x: x["hit"] != "")
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,hit:string,n:int>>")
    return F.when(text.rlike(pattern), rows.cast("array<struct<kind:int,i:int,gap:int,hit:string,n:int>>")).otherwise(none)


def _two_sided(z: Column) -> Column:
    """Two-sided normal tail, to an absolute error of 2e-7 (rational approximation of the error function)."""

    def tail(x: Column) -> Column:
        poly = lambda t: t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
        return let(1 / (1 + 0.3275911 * x), poly) * F.exp(-x * x)

    return let(F.abs(z) / math.sqrt(2), tail)


def _upper(z: Column) -> Column:
    return let(z, lambda v: let(_two_sided(v) / 2, lambda half: F.when(v >= 0, half).otherwise(1 - half)))


def _chi_tail(stat: Column, df: Column) -> Column:
    """Upper tail of chi-squared (cube-root normal approximation)."""
    return _upper((F.pow(F.greatest(stat, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))


def _measures(token: Column, alphabet: Column, k: Column) -> Column:
    """Struct of what the tests need: sum of squared symbol counts, symbols above the middle, runs, serial sums."""
    values = F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c))

    def one_pass(v: Column) -> Column:
        zero = F.struct(F.lit(0).alias("p"), F.lit(0).alias("c"), F.lit(0).cast("long").alias("n"))
        count = lambda a, x: F.when(x == a["p"], a["c"] + 1).otherwise(F.lit(1))
        squares = F.aggregate(F.array_sort(v), zero, lambda a, x: F.struct(x.alias("p"), count(a, x).alias("c"), (a["n"] + 2 * count(a, x) - 1).alias("n")), lambda a: a["n"])
        high = lambda x: 2 * x > k
        centre = lambda x: x - (k + 1) / 2
        start = F.struct(F.lit(0).alias("p"), F.lit(0).alias("runs"), F.lit(0).alias("above"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
        step = lambda a, x: F.struct(
            x.alias("p"),
            (a["runs"] + F.when((a["p"] > 0) & (high(a["p"]) == high(x)), 0).otherwise(1)).alias("runs"),
            (a["above"] + high(x).cast("int")).alias("above"),
            (a["s"] + F.when(a["p"] > 0, centre(a["p"]) * centre(x)).otherwise(0.0)).alias("s"),
            (a["q"] + centre(x) * centre(x)).alias("q"),
        )
        return F.struct(squares.alias("squares"), F.aggregate(v, start, step).alias("walk"))

    return let(values, one_pass)


def _battery(classes: Column) -> Column:
    """Smallest p-value of the tests times their number (at most 1); ``classes`` is the p-value of the class test."""
    n, k, above, runs = (F.col(c).cast("double") for c in ("len", "k", "above", "runs"))
    mean = 2 * above * (n - above) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs_p = F.when(var > 0, _two_sided((runs - mean) / F.sqrt(F.greatest(var, F.lit(1e-9))))).otherwise(F.lit(0.0))
    symbols = _chi_tail(F.col("squares") * k / n - n, k - 1)
    serial = _two_sided(F.col("s") / F.greatest(F.col("q"), F.lit(1.0)) * F.sqrt(n))
    return F.least(F.lit(1.0), 4 * F.least(symbols, classes, runs_p, serial))


def class_shares(docs: DataFrame, text_col: str) -> list[float]:
    """Shares of the classes among all such characters of the corpus, each at least a millionth."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    patterns = ("[A-Z]", "[a-z]", "[0-9]", "[+/_-]")
    counts = docs.agg(*[F.sum((F.size(F.split(text, p, -1)) - 1).cast("long")).alias(c) for c, p in zip(CLASSES, patterns)]).first()
    total = sum(counts[c] or 0 for c in CLASSES)
    return [max((counts[c] or 0) / max(total, 1), 1e-6) for c in CLASSES]


def letter_bits(docs: DataFrame, text_col: str) -> list[float]:
    """Of each letter after another (place 27 * before + letter, 0: none before): log2 of uniform to the corpus's share."""
    found = docs.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit("[a-z]{2,}+"), F.lit(0))).alias("word"))
    found = found.groupBy("word").agg(F.count("*").alias("n"))
    pairs = F.transform(F.sequence(F.lit(0), F.length("word") - 1), lambda i: F.concat(F.when(i > 0, F.substring("word", i, F.lit(1))).otherwise(""), F.substring("word", i + 1, F.lit(1))))
    counts = found.select("n", F.explode(pairs).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n")).collect()  # 702 rows at most
    n = [[0] * 27 for _ in range(27)]
    for r in counts:
        before, letter = (0, *(_LOWER.index(c) + 1 for c in r["pair"]))[-2:]
        n[before][letter] = r["n"]
    return [0.0 if not letter else math.log2((sum(row) + 26) / (row[letter] + 1) / 26) for row in n for letter in range(27)]


def _letters_say(token: Column, bits: list[float]) -> Column:
    """Sum of ``letter_bits`` over a token."""
    table = F.array(*[F.lit(b) for b in bits])
    start = F.struct(F.lit(0).alias("p"), F.lit(0.0).alias("b"))
    step = lambda a, x: F.struct(x.alias("p"), (a["b"] + F.get(table, a["p"] * 27 + x)).alias("b"))
    return F.aggregate(F.transform(F.split(F.lower(token), ""), lambda c: F.instr(F.lit(_LOWER), c)), start, step, lambda a: a["b"])


def parts(tokens: DataFrame, own: list[str]) -> DataFrame:
    """``tokens`` of one alphabet as they are and the long parts of those with signs: own, kind, hit, start, end."""
    no_part = F.array().cast("array<struct<kind:int,i:int,gap:int,hit:string,n:int>>")
    signed = F.when(F.col("hit").rlike("[+/_-]"), F.concat(*[_matches(F.col("hit"), j, p, 0) for j, p in enumerate(PARTS)])).otherwise(no_part)
    one_alphabet = F.col("hit").rlike("^(?:[A-Za-z0-9+/]+|[A-Za-z0-9_-]+)$")
    columns = [*own, "kind", "hit", "start", "end"]
    inner = tokens.select(*own, "kind", F.col("start").alias("at"), F.explode(signed).alias("m")).select(*own, "kind", "at", F.col("m.kind").alias("j"), "m.i", "m.gap", "m.hit")
    upto = F.sum(F.col("gap") + F.length("hit")).over(W.partitionBy("rid", "at", "j").orderBy("i"))
    inner = inner.withColumn("end", (F.col("at") + upto).cast("long")).withColumn("start", F.col("end") - F.length("hit"))
    return tokens.where(one_alphabet).select(columns).unionByName(inner.select(columns)).dropDuplicates(["rid", "start", "end"])


def random_tokens(hits: DataFrame, shares: list[float], letters: list[float], level: float, false_share: float, bins_per_bit: int = 8) -> DataFrame:
    """Those of ``hits`` that pass the battery and the false-discovery step-up; ``evidence`` is in bits."""
    token = F.col("hit")
    encoding = (
        F.when(token.rlike(f"^[{_DIGIT}]+$"), F.lit(None))
        .when(token.rlike("^[0-9a-f]+$"), "hex_lower")
        .when(token.rlike("^[0-9A-F]+$"), "hex_upper")
        .when(token.rlike("^[A-Z]+$"), "upper")
        .when(token.rlike("^[a-z]+$"), "lower")
        .when(token.rlike("^[A-Za-z]+$"), "letters")
        .when(token.rlike("^[A-Z2-7]+$"), "base32")
        .when(token.rlike("^[A-Za-z0-9+/]+$"), "base64")
        .when(token.rlike("^[A-Za-z0-9_-]+$"), "base64url")
    )
    counts = {c: F.length(token) - F.length(F.regexp_replace(token, p, "")) for c, p in zip(CLASSES, ("[A-Z]", "[a-z]", "[0-9]", "[+/_-]"))}
    by = lambda pick: F.coalesce(*[F.when(F.col("encoding") == n, F.lit(pick(*ALPHABETS[n]))) for n in ALPHABETS])
    rows = hits.withColumns({"len": F.length(token), "encoding": encoding, **counts}).where("encoding is not null")
    rows = rows.withColumns({"k": by(lambda a, _: len(a)), "alphabet": by(lambda a, _: a)})
    rows = rows.withColumns({"m": _measures(token, F.col("alphabet"), F.col("k")), "letters": _letters_say(token, letters)})
    rows = stage(rows.drop("hit", "alphabet").select("*", "m.squares", "m.walk.runs", "m.walk.above", "m.walk.s", "m.walk.q").drop("m"), "candidates")

    stats, bits, df = F.lit(0.0), F.lit(0.0), F.lit(1)
    for name, (alphabet, sizes) in ALPHABETS.items():
        live = [(c, F.col("len") * (s / len(alphabet))) for c, s in zip(CLASSES, sizes) if s]
        stat = sum((F.pow(F.col(c) - e, F.lit(2.0)) / e for c, e in live), F.lit(0.0))
        stats = F.when(F.col("encoding") == name, stat).otherwise(stats)
        df = F.when(F.col("encoding") == name, len(live) - 1).otherwise(df)
        against = lambda of: sum((F.col(c) * math.log2(size / share / len(alphabet)) for c, size, share in zip(CLASSES, _CLASS_SIZE, of)), F.lit(0.0))  # noqa: E731, B023
        case = shares[0] + shares[1]
        weaker = F.least(against(shares), F.when((F.col("upper") == 0) | (F.col("lower") == 0), against([case, case, *shares[2:]])))
        bits = F.when(F.col("encoding") == name, weaker).otherwise(bits)
    # An alphabet of one class has nothing to test there.
    rows = rows.withColumns({"class_p": F.when(df == 0, 1.0).otherwise(_chi_tail(stats, F.greatest(df, F.lit(1)))), "evidence": bits + F.col("letters")})
    rows = stage(rows.withColumn("battery", _battery(F.col("class_p"))), "candidates")

    # Step-up over all candidates: the smallest evidence e with 2**-e <= false_share * (candidates of at least e) / all.
    tested = rows.withColumn("bin", F.floor(F.greatest(F.lit(0.0), F.least(F.col("evidence"), F.lit(512.0))) * bins_per_bit))
    passed = F.col("battery") >= level
    sizes = tested.groupBy("bin").agg(F.count("*").alias("n"), F.sum(passed.cast("long")).alias("ok")).orderBy(F.desc("bin")).collect()  # 4,097 rows at most
    total, so_far, threshold = sum(r["n"] for r in sizes), 0, None
    for r in sizes:
        so_far += r["ok"]
        if so_far and 2.0 ** -(r["bin"] / bins_per_bit) <= false_share * so_far / total:
            threshold = r["bin"]
    return tested.where(passed & (F.col("bin") >= (10**9 if threshold is None else threshold)))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: float = 0.01, false_share: float = 0.01, digests: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows (rid, doc_id), one for each row of ``docs``, and their spans (rid, doc_id, kind, name, start, end); code points, end exclusive.

    With ``digests`` spans also have the ``sha`` of their text: a row's spans follow from its text and the corpus alone.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = F.concat(*[_matches(text, rank, pattern, group) for rank, (_, pattern, _, group) in enumerate((*KINDS, RANDOM))])
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), found.alias("found"), text.alias("t"))
    own = ["rid", "doc_id", *(["sha"] if digests else [])]
    if digests:
        rows = rows.withColumn("sha", F.when(F.size("found") > 0, text_sha("t")))
    rows = stage(rows.select(*own, "found"), "secret_rows")
    one = rows.where(F.size("found") > 0).select(*own, F.explode("found").alias("m")).select(*own, "m.*")
    upto = F.sum(F.col("gap") + F.length("hit")).over(W.partitionBy("rid", "kind").orderBy("i"))
    placed = one.withColumn("end", upto.cast("long")).withColumn("start", F.col("end") - F.length("hit"))
    shortest = F.element_at(F.array(*[F.lit(k[2]) for k in (*KINDS, RANDOM)]), F.col("kind") + 1)
    placed = stage(placed.where(F.col("n") >= shortest), "secret_hits")
    columns = [*own, "kind", "start", "end"]
    base = placed.where(F.col("kind") < len(KINDS)).select(columns)
    tokens = parts(placed.where(F.col("kind") == len(KINDS)), own)
    random = random_tokens(tokens, class_shares(docs, text_col), letter_bits(docs, text_col), level, false_share).select(columns)
    wider = F.max("end").over(W.partitionBy("rid").orderBy("start", F.desc("end")).rowsBetween(W.unboundedPreceding, -1))
    random = random.withColumn("wider", wider).where("wider is null or wider < end").drop("wider")
    # A random token inside what a fixed kind has found says nothing new.
    is_base = F.col("kind") < len(KINDS)
    order = W.partitionBy("rid").orderBy("start")
    before = F.max(F.when(is_base, F.col("end"))).over(order.rangeBetween(W.unboundedPreceding, W.currentRow))
    after = F.min(F.when(is_base, F.col("start"))).over(order.rangeBetween(W.currentRow, W.unboundedFollowing))
    new = is_base | ((F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end")))
    spans = base.unionByName(random).withColumn("new", new).where("new").drop("new")
    name = F.element_at(F.array(*[F.lit(k[0]) for k in (*KINDS, RANDOM)]), F.col("kind") + 1)
    return rows.select("rid", "doc_id"), stage(spans.withColumn("name", name), "secret_spans")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base, spans): counts and kind:start:end lists of every row."""
    rows, spans = find_spans(docs, id_col, text_col, **params)
    one = F.struct("start", "kind", F.concat_ws(":", "name", "start", "end").alias("s"))
    counts = [F.count_if(F.col("kind") == i).alias(f"n_{k[0]}") for i, k in enumerate((*KINDS, RANDOM))]
    found = spans.groupBy("rid").agg(*counts, F.sort_array(F.collect_list(one)).alias("a"))
    text = lambda a: F.coalesce(F.array_join(F.transform(a, lambda x: x["s"]), ","), F.lit(""))
    base = text(F.filter("a", lambda x: x["kind"] < len(KINDS))).alias("base")
    numbers = [F.coalesce(f"n_{k[0]}", F.lit(0)).cast("long").alias(f"n_{k[0]}") for k in (*KINDS, RANDOM)]
    return rows.join(found, "rid", "left").select("doc_id", *numbers, base, text(F.col("a")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]", **params) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; all rows and columns stay, rows without spans as they are.

    Spans are joined by the digest of the text, so null and repeated ids don't matter. ``n_chars``, if there, follows the text.
    """
    with recorded() as made:
        _, spans = find_spans(docs, id_col, text_col, digests=True, **params)
    spans = spans.select("sha", "start", "end").distinct()
    order = W.partitionBy("sha").orderBy("start", "end")
    apart = F.col("start") >= F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    island = F.sum(apart.cast("int")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    merged = spans.withColumn("island", island).groupBy("sha", "island").agg(F.min("start").alias("s"), F.max("end").alias("e"))
    lists = stage(merged.groupBy("sha").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("_spans")).withColumnRenamed("sha", "_span_sha"), "redactions")
    drop(*made)
    rows = docs.join(lists, text_sha(docs[text_col].cast("string")) == F.col("_span_sha"), "left")
    ends = F.transform("_spans", lambda x: x["e"])
    starts = F.concat(F.transform("_spans", lambda x: x["s"]), F.array(F.length(text_col).cast("long")))
    kept = F.transform(starts, lambda s, i: F.substring(F.col(text_col), (F.coalesce(F.get(ends, i - 1), F.lit(0)) + 1).cast("int"), (s - F.coalesce(F.get(ends, i - 1), F.lit(0))).cast("int")))
    text = F.when(F.col("_spans").isNull(), F.col(text_col)).otherwise(F.array_join(kept, mark))
    out = rows.withColumn(text_col, text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length(text_col)).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
