"""Operator 3: secret scans with a randomness test battery, native Spark SQL.

Base rules find assignments, access ids and long hexadecimal runs. Besides,
every maximal token of 8 or more key-like characters gets an encoding (hex, base32,
base62 or base64, the smallest alphabet that holds it) and three tests of the
hypothesis that its symbols are independent and uniform over that alphabet:

* chi-squared of the symbol counts (Wilson-Hilferty),
* runs of digits against letters (hex, base32) or of lower case against the
  rest (base62, base64),
* lag-1 serial correlation of the symbols' places in the alphabet.

A token passes the battery if the smallest of the three p-values, times
three, is at least ``min_p``. Passing says little about a short token, so the
false discoveries are controlled by length: the evidence against ordinary
text is the likelihood ratio of the uniform alphabet to a Markov chain over
character classes of words, identifiers and numbers. It is an e-value (its
mean is at most 1 under that chain) and grows with the length. Within each
document and band of lengths (8, 12, 16, and 20 characters or more) the e-BH
rule keeps the k largest with evidence >= tokens / (k q). The many words of 8
letters so do not raise the cut of long keys; q holds within each band.

Positions come from ``split`` and ``regexp_extract_all`` on the same pattern:
gaps and matches alternate, so their code-point lengths add up to the spans.

Defined cases: a null text is the empty text and gives no spans; repeated
rows give repeated results; an empty table gives an empty result; no other
column is read; texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import table

ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: The length bounds are in the two patterns below; a maximal run is long
#: enough or not, so the runs found are the same as by filtering afterwards.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: From 8 characters on, the evidence of a random base62 token reaches
#: log(1/q) on average (0.67 a character at q = 0.01); a shorter one is no candidate.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{8,}={0,2}"
#: Least lengths of the bands of tokens that e-BH judges each by itself.
BANDS = (8, 12, 16, 20)
#: Tokens that no cut can keep: all of one class (no runs to test, p = 0) or
#: a capitalized word (negative evidence). They count, but need no tests.
PLAIN = r"^(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)=*$"
KINDS = ("assign", "access", "hex", "random")

_ALPHABETS = {
    "hex": "0123456789abcdef",
    "hexu": "0123456789ABCDEF",
    "b32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "b62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Classes l(ower), u(pper), d(igit), s(ymbol): share of each alphabet ...
_SHARE = {
    "hex": {"l": 6 / 16, "d": 10 / 16}, "hexu": {"u": 6 / 16, "d": 10 / 16},
    "b32": {"u": 26 / 32, "d": 6 / 32}, "b62": {"l": 26 / 62, "u": 26 / 62, "d": 10 / 62},
    "b64": {"l": 26 / 64, "u": 26 / 64, "d": 10 / 64, "s": 2 / 64},
}
#: ... and the chain of ordinary text: from class to class.
_CHAIN = {
    "l": {"l": 0.90, "u": 0.05, "d": 0.03, "s": 0.02}, "u": {"l": 0.40, "u": 0.55, "d": 0.03, "s": 0.02},
    "d": {"l": 0.05, "u": 0.05, "d": 0.85, "s": 0.05}, "s": {"l": 0.50, "u": 0.20, "d": 0.20, "s": 0.10},
}


_BLOCK = 256  # matches whose places are summed up at once
_PIECE = 1024  # characters of a text that gaps are cut from
_NO_SPANS = "cast(array() as array<struct<start:bigint,kind:int,end:bigint,m:string>>)"


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pairs(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (gap, match, group of the match); the last one is the text's
    rest, with null for the match."""
    return F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"))


def _blocks(found: Column) -> Column:
    return _bind(found, lambda f: F.transform(F.sequence(F.lit(0), F.floor((F.size(f) - 1) / _BLOCK).cast("int")),
                                              lambda i: F.slice(f, i * _BLOCK + 1, F.lit(_BLOCK))))


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Array of (start, kind, end, match) of the pattern's leftmost
    non-overlapping matches whose ``group`` has ``least`` characters.

    Places are running sums, taken within blocks of matches and then over the
    blocks, so that a text with very many matches stays affordable."""
    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["g"])
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("m"))
        out = F.when(F.length(x["v"]) >= least, F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct(end.alias("pos"), out.alias("out"))

    def placed(inner: Column) -> Column:
        starts = F.aggregate(inner, F.expr("struct(0L as pos, cast(array() as array<bigint>) as out)"),
                             lambda acc, b: F.struct((acc["pos"] + b["pos"]).alias("pos"), F.concat(acc["out"], F.array(acc["pos"])).alias("out")),
                             lambda acc: acc["out"])
        return F.flatten(F.zip_with(inner, starts, lambda b, at: F.transform(b["out"], lambda x: F.struct(
            (x["start"] + at).alias("start"), x["kind"].alias("kind"), (x["end"] + at).alias("end"), x["m"].alias("m")))))

    found = F.filter(_pairs(text, pattern, group), lambda x: x["m"].isNotNull())
    inner = F.transform(_blocks(found), lambda b: F.aggregate(b, F.expr(f"struct(0L as pos, {_NO_SPANS} as out)"), step))
    return F.when(F.regexp(text, F.lit(pattern)), _bind(inner, placed)).otherwise(F.expr(_NO_SPANS))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation)."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z)))


def _per_encoding(enc: Column, value) -> Column:
    out = F.lit(None)
    for name in reversed(list(_ALPHABETS)):
        out = F.when(enc == name, value(name)).otherwise(out)
    return out


def _battery(m: Column) -> Column:
    """(p, log evidence) of a token."""
    body = F.regexp_replace(m, "=+$", "")
    enc = (F.when(F.regexp(body, F.lit("^[0-9a-f]+$")), "hex").when(F.regexp(body, F.lit("^[0-9A-F]+$")), "hexu")
           .when(F.regexp(body, F.lit("^[A-Z2-7]+$")), "b32").when(F.regexp(body, F.lit("^[A-Za-z0-9]+$")), "b62")
           .otherwise("b64"))
    body = F.translate(body, "-_", "+/")
    alphabet = _per_encoding(enc, lambda e: F.lit(_ALPHABETS[e]))
    classes = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(body, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d"), "+/", "ss")
    size = _per_encoding(enc, lambda e: F.lit(float(len(_ALPHABETS[e]))))
    first = F.struct(body.alias("body"), classes.alias("cls"), enc.alias("enc"), size.alias("size"), alphabet.alias("abc"),
                     F.length(body).cast("double").alias("n"), F.filter(F.split(body, ""), lambda c: c != "").alias("chars"))

    def tests(t: Column) -> Column:
        n, size = t["n"], t["size"]
        chars = t["chars"]
        squares = F.aggregate(F.array_distinct(chars), F.lit(0.0),
                              lambda a, c: a + F.pow(n - F.length(F.replace(t["body"], c, F.lit(""))), F.lit(2.0)))
        chi, dof = size / n * squares - n, size - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / dof, F.lit(1 / 3)) - (1 - 2 / (9 * dof))) / F.sqrt(2 / (9 * dof))
        # runs of one class against the rest
        one = F.when(t["enc"].isin("hex", "hexu", "b32"), F.translate(t["cls"], "lus", "xxx")).otherwise(F.translate(t["cls"], "uds", "xxx"))
        n0 = F.length(F.replace(one, F.lit("x"), F.lit(""))).cast("double")
        runs = 1 + F.regexp_count(one, F.lit("(?<=x)[^x]|(?<=[^x])x"))

        def z_of_runs(a: Column) -> Column:
            prod = 2 * a["n0"] * (n - a["n0"])
            var = prod * (prod - n) / (n * n * (n - 1))
            return F.when(var > 0, F.abs(a["runs"] - prod / n - 1) / F.sqrt(var)).otherwise(F.lit(99.0))
        z_runs = _bind(F.struct(n0.alias("n0"), runs.alias("runs")), z_of_runs)
        # serial correlation
        places = F.transform(chars, lambda c: F.instr(t["abc"], c).cast("double"))
        # sums of x, x^2, x y over neighbours, and the first and last place
        sums = F.aggregate(places, F.expr("struct(0D as x, 0D as xx, 0D as xy, cast(null as double) as first, cast(null as double) as last)"),
                           lambda a, x: F.struct((a["x"] + x).alias("x"), (a["xx"] + x * x).alias("xx"),
                                                 (a["xy"] + F.coalesce(a["last"] * x, F.lit(0.0))).alias("xy"),
                                                 F.coalesce(a["first"], x).alias("first"), x.alias("last")))

        def lagged(a: Column) -> Column:
            mean = a["x"] / n
            total = a["xx"] - n * mean * mean
            lag = a["xy"] - mean * (2 * a["x"] - a["first"] - a["last"]) + (n - 1) * mean * mean
            return F.when(total > 1e-9, F.abs(lag / total + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0))
        z_lag = _bind(sums, lagged)
        p = F.least(F.lit(1.0), 3 * F.least(_bind(z_chi, _tail), 2 * _bind(z_runs, _tail), 2 * _bind(z_lag, _tail)))
        import math
        evidence = F.lit(0.0)
        for a, row in _CHAIN.items():
            for b, q in row.items():
                gain = _per_encoding(t["enc"], lambda e: F.lit(math.log(_SHARE[e].get(b, 1e-9) / q)))  # noqa: B023
                evidence = evidence + F.regexp_count(t["cls"], F.lit(f"(?<={a}){b}")) * gain
        return F.struct(p.alias("p"), evidence.alias("e"))

    return _bind(first, tests)


_IS_BASE = f"^(?:{HEX}|{ACCESS})$"


def _least_evidence(tested: Column, min_p: float, q: float) -> Column:
    """The e-BH rule over a document's tests (array of (p, e), null for what
    is no candidate): the least log evidence that is kept; null for none."""
    n = F.size(F.filter(tested, lambda b: b.isNotNull()))
    strong = F.sort_array(F.transform(F.filter(tested, lambda b: b["p"] >= min_p), lambda b: b["e"]), asc=False)
    return _bind(n, lambda n: F.array_min(F.transform(strong, lambda e, i: F.when(e >= F.log(n / ((i + 1) * F.lit(q))), e))))


def find_secrets(df: DataFrame, text_col: str = "text", out_col: str = "found", min_p: float = 0.001,
                 q: float = 0.01) -> DataFrame:
    """``df`` with ``out_col``: array of (start, kind, end, m), sorted by start
    and kind (index into KINDS); code points, end exclusive; ``m`` the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(_spans(text, ASSIGN, 0, 2, 12), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    tokens = F.filter(_spans(text, TOKEN, 3), lambda x: ~F.regexp(x["m"], F.lit(_IS_BASE)))
    tested = F.transform(tokens, lambda x: F.struct(x.alias("x"), F.when(F.regexp(x["m"], F.lit(PLAIN)), F.expr("struct(0D as p, 0D as e)"))
                                                    .otherwise(_battery(x["m"])).alias("b"), F.length(F.regexp_replace(x["m"], "=+$", "")).alias("n")))
    out = df.withColumn("__base", base).withColumn("__tested", tested)
    def kept(band: Column) -> Column:
        # bound, as the optimizer would move the rule into the filter, once per token
        return _bind(_least_evidence(F.transform(band, lambda t: t["b"]), min_p, q), lambda least: F.transform(
            F.filter(band, lambda t: (t["b"]["p"] >= min_p) & (t["b"]["e"] >= least)), lambda t: t["x"]))

    bands = [F.filter("__tested", lambda t: (t["n"] >= low) & (t["n"] < high)) for low, high in zip(BANDS, [*BANDS[1:], 1 << 31])]  # noqa: B023
    added = F.concat(*[_bind(band, kept) for band in bands])
    return out.withColumn(out_col, F.sort_array(F.concat("__base", added))).drop("__base", "__tested")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan_digest(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    found = find_secrets(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    def n(k: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(_joined(F.filter("found", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
                        _joined(F.col("found")).alias("spans"))


def _kept_text(text: Column, pieces: Column, found: Column, mask: str) -> Column:
    """``text`` with the union of the spans ``found`` (sorted by start)
    replaced by ``mask``, overlapping and touching spans once.

    The gap before a span begins at the largest end of the spans before it,
    taken within blocks of spans and then over the blocks. Gaps are cut from
    ``pieces`` of _PIECE characters, so the cost grows with the length."""
    def step(acc: Column, x: Column) -> Column:
        one = F.struct(acc["pos"].alias("since"), x["start"].alias("start"))
        return F.struct(F.greatest(acc["pos"], x["end"]).alias("pos"), F.concat(acc["out"], F.array(one)).alias("out"))

    def gaps(inner: Column) -> Column:
        ends = F.aggregate(inner, F.expr("struct(-1L as pos, cast(array() as array<bigint>) as out)"),
                           lambda acc, b: F.struct(F.greatest(acc["pos"], b["pos"]).alias("pos"), F.concat(acc["out"], F.array(acc["pos"])).alias("out")),
                           lambda acc: acc["out"])
        return F.flatten(F.zip_with(inner, ends, lambda b, at: F.transform(b["out"], lambda x: F.struct(
            F.greatest(x["since"], at).alias("since"), x["start"].alias("start")))))

    def cut(since: Column, until: Column) -> Column:
        a, b = F.floor(since / _PIECE).cast("int"), F.floor(until / _PIECE).cast("int")
        skip = (since - a * F.lit(_PIECE)).cast("int")
        one = F.substring(F.get(pieces, a), skip + 1, (until - since).cast("int"))
        head = F.substring(F.get(pieces, a), skip + 1, F.lit(_PIECE))
        inner = F.when(b > a + 1, F.array_join(F.slice(pieces, a + 2, b - a - 1), "")).otherwise("")
        last = F.coalesce(F.substring(F.get(pieces, b), F.lit(1), (until - b * F.lit(_PIECE)).cast("int")), F.lit(""))
        return F.coalesce(F.when(a == b, one).otherwise(F.concat(head, inner, last)), F.lit(""))

    inner = F.transform(_blocks(found), lambda b: F.aggregate(
        b, F.expr("struct(-1L as pos, cast(array() as array<struct<since:bigint,start:bigint>>) as out)"), step))
    # a span at the text's begin has a gap of no characters: since is -1 there
    parts = F.transform(_bind(inner, gaps), lambda x: F.when(
        x["start"] > x["since"], F.concat(cut(F.greatest(x["since"], F.lit(0)), x["start"]), F.lit(mask))).otherwise(""))
    rest = cut(F.array_max(F.transform(found, lambda x: x["end"])), F.length(text).cast("bigint"))
    return F.concat(F.array_join(parts, ""), rest)


def redact(df: DataFrame, text_col: str = "text", mask: str = "[SECRET]", min_p: float = 0.001, q: float = 0.01) -> DataFrame:
    """``df`` with every span of ``find_secrets`` in ``text_col`` replaced by
    ``mask``; overlapping and touching spans are replaced once. Null stays
    null."""
    text = F.col(text_col)
    out = find_secrets(df, text_col, "__found", min_p, q)
    some = F.size("__found") > 0
    out = out.withColumn("__pieces", F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))))
    masked = F.when(some, _kept_text(text, F.col("__pieces"), F.col("__found"), mask)).otherwise(text)
    return out.withColumn(text_col, masked).drop("__found", "__pieces")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_digest(table(spark, sf_dir, "documents"))
