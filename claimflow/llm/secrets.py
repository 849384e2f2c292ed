"""Secret scan with multipart credential linking, by DataFrame functions only (operator 12).

Base kinds are always reported: ``assign`` (a key word, a sign, a value of six or more),
``access`` (an access key id) and ``hex`` (24 or more hexadecimal digits). Weak kinds say
little alone: ``ident`` (a name given to an account, client or access key), ``endpoint``
(an address of a service) and ``value`` (a pass phrase under a lesser key word, or 24 or
more characters of letters and digits mixed). A credential has several parts, so a weak
candidate is reported only beside parts that complete it, in its scope (the text between
two blank lines) and within ``REACH`` code points:

    ident     a secret (assign, hex, value)
    value     an identifier (access, ident) or an endpoint
    endpoint  a secret and an identifier

A weak candidate that overlaps a base span, or a weak one of a kind named before its own
in ``WEAK``, is part of that and dropped.

A pattern's matches and the pieces between them give the lengths of both; running sums over
them are the places. The parts of a text, which are few, are exploded; the interval join is
a window over each scope by place: the nearest end before and the nearest start after a part,
for each role, so the work is linear and no pairs are made. Texts are never shuffled. Rows
that repeat id and text are scanned once for each and joined into one before the windows,
so a hot copy is one group, and given out as often as they came.

Null and empty texts have no secrets. Null ids are kept. Other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points between two parts that may belong together.
REACH = 300


def any_case(words: str) -> str:
    """A pattern that takes ASCII letters in either case (and no other letters that fold to them)."""
    return re.sub(r"[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


_SET = r"[\"']?\x20*[:=]\x20*[\"']?"

# ---- fixed values: the base kinds ----
ASSIGN = f"({any_case('password|passwd|secret|token|api_?key')}){_SET}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
#: Runs are taken whole, so those of 24 and more are found as such.
HEX = "[0-9a-f]{24,}"
LEAST_VALUE, LEAST_ACCESS = 6, 20

# ---- weak kinds ----
IDENT = (f"({any_case('access_?key_?id|access_?key|client_?id|app_?id|account_?id|user_?name|user_?id|login')})"
         f"{_SET}[A-Za-z0-9@._+-]{{3,}}")
ENDPOINT = (f"({any_case('https?|wss?|ftps?|amqps?|redis|mongodb|mysql|postgresql|postgres|jdbc:[a-z]+')})"
            r"://[^\x20\x09-\x0D\"'<>]+"
            f"|({any_case('hostname|host|endpoint|server|region|bucket')}){_SET}[A-Za-z0-9.:/_-]{{3,}}")
VALUE = (f"({any_case('pwd|passphrase|passcode|private_?key|signature|credentials?')}){_SET}"
         r"[^\x20\x09-\x0D\"']{4,}|[A-Za-z0-9+/_-]{24,}")
#: What a value of letters and digits alone must hold.
DIGIT, LETTER, KEYED = "[0-9]", "[A-Za-z]", f"^({any_case('pwd|passphrase|passcode|private_?key|signature|credentials?')}){_SET}"
BLANK_LINE = r"\n[\x20\x09\x0D]*\n"

KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "ident": IDENT, "endpoint": ENDPOINT, "value": VALUE}
BASE, WEAK = ("assign", "access", "hex"), ("ident", "endpoint", "value")
SECRET, IDENTIFIER = ("assign", "hex", "value"), ("access", "ident")


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """(kind, at, gap, len, ok) of each match, ``gap`` being the length of the text before it from the last one.

    The arrays are zipped, as an array named inside a lambda is built anew for each element.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if kind == "assign":
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        found = F.zip_with(found, values, lambda m, v: F.struct(m.alias("m"), v.alias("v")))
    else:
        found = F.transform(found, lambda m: F.struct(m.alias("m"), m.alias("v")))
    # one piece more than matches: what stands after the last
    paired = F.filter(F.zip_with(found, F.split(text, pattern, -1), lambda f, g: F.struct(f.alias("f"), g.alias("g"))),
                      lambda x: x["f"].isNotNull())

    def one(x: Column, i: Column) -> Column:
        m, v = x["f"]["m"], x["f"]["v"]
        ok = {"assign": lambda: F.char_length(v) >= LEAST_VALUE, "access": lambda: F.char_length(m) >= LEAST_ACCESS,
              "value": lambda: m.rlike(KEYED) | (m.rlike(DIGIT) & m.rlike(LETTER))}.get(kind, lambda: F.lit(True))()
        return F.struct(F.lit(kind).alias("kind"), i.alias("at"), F.char_length(x["g"]).alias("gap"),
                        F.char_length(m).alias("len"), ok.alias("ok"))

    none = F.array().cast("array<struct<kind:string,at:int,gap:int,len:int,ok:boolean>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), F.transform(paired, one)).otherwise(none)


def _parts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """A row for each part of each (doc_id, digest of the text), or one without a part; n_rows is how often it came."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = whole.select("doc_id", "text", F.concat(*(_matches(F.col("text"), k, p) for k, p in KINDS.items())).alias("parts"))
    some = F.exists("parts", lambda p: p["ok"])
    found = found.select(
        "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"),
        F.when(some, F.concat("parts", _matches(F.col("text"), "blank", BLANK_LINE))).alias("parts"))
    # equal keys have equal parts
    once = found.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n_rows"), F.any_value("parts").alias("parts"))
    return once.select("doc_id", "digest", "n_rows", F.explode_outer("parts").alias("part")).select(
        "doc_id", "digest", "n_rows", "part.*")


def _sides(*key: str):
    """Windows over the parts before and after a part, both as growing frames, which are linear
    (a frame that ends at the last row is gone through anew for each row)."""
    return tuple(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
                 for order in (("start", "rank"), (F.desc("start"), F.desc("rank"))))


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", reach: int = REACH) -> DataFrame:
    """(doc_id, digest, n_rows, kind, start, end, base): every reported span, and a row with a null kind
    for a text without a candidate. Places are code points, ends exclusive."""
    key = ["doc_id", "digest"]
    end = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy(*key, "kind").orderBy("at"))
    placed = (_parts(docs, text, doc_id).withColumn("end", end.cast("long"))
              .withColumn("start", F.col("end") - F.col("len")).where(F.coalesce("ok", F.lit(True))))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    level = F.when(F.col("kind").isin(*BASE), 0).otherwise(rank - len(BASE))

    by = Window.partitionBy(*key).orderBy("start", "rank")
    before, after = _sides(*key)
    ranked = placed.withColumns({"rank": rank, "level": level})
    covered = F.lit(False)
    for k, kind in enumerate(WEAK):      # by what stands before its own kind
        stronger = (F.col("level") <= k) & (F.col("kind") != "blank")
        over = ((F.max(F.when(stronger, F.col("end"))).over(before) > F.col("start"))
                | (F.min(F.when(stronger, F.col("start"))).over(after) < F.col("end")))
        covered = F.when(F.col("kind") == kind, F.coalesce(over, F.lit(False))).otherwise(covered)
    free = ranked.select("*", F.sum((F.col("kind") == "blank").cast("int")).over(by).alias("scope"),
                         covered.alias("covered")).where(F.col("kind").isNull() | ~F.col("covered"))

    before, after = _sides(*key, "scope")

    def near(kinds: tuple) -> Column:
        own = F.col("kind").isin(*kinds)
        return (F.coalesce(F.col("start") - F.max(F.when(own, F.col("end"))).over(before) <= reach, F.lit(False))
                | F.coalesce(F.min(F.when(own, F.col("start"))).over(after) - F.col("end") <= reach, F.lit(False)))

    joined = free.withColumns({"secret": near(SECRET), "identifier": near(IDENTIFIER), "endpoint": near(("endpoint",))})
    linked = (F.when(F.col("kind") == "ident", F.col("secret"))
              .when(F.col("kind") == "value", F.col("identifier") | F.col("endpoint"))
              .when(F.col("kind") == "endpoint", F.col("secret") & F.col("identifier"))
              .otherwise(True))
    kind = F.when((F.col("kind") != "blank") & linked, F.col("kind"))     # a text's parts may all go
    return joined.select(*key, "n_rows", kind.alias("kind"), "start", "end", "rank", F.col("kind").isin(*BASE).alias("base"))


def _spelled(found: Column) -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(found), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", reach: int = REACH) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_weak."""
    found = spans(docs, text, doc_id, reach)
    span = F.struct("start", "rank", "kind", "end")
    every = found.groupBy("doc_id", "digest").agg(
        F.max("n_rows").alias("n_rows"), *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE),
        F.collect_list(F.when(F.col("kind").isNotNull() & F.col("base"), span)).alias("own"),
        F.collect_list(F.when(F.col("kind").isNotNull(), span)).alias("all"))
    return every.select(
        "doc_id", *(f"n_{k}" for k in BASE), F.sha2(_spelled(F.col("own")), 256).alias("base_sha256"),
        _spelled(F.col("all")).alias("spans"),
        (F.size("all") - F.size("own")).cast("long").alias("n_weak"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))).alias("row")).drop("row")
