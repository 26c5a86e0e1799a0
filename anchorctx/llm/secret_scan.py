"""Secret scan: strong finds, and weak ones that complementary parts nearby confirm."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, saved, text_or_empty


@dataclass(frozen=True)
class Kind:
    """A pattern whose leftmost matches, none overlapping, are spans if they pass a test."""

    name: str
    pattern: str
    role: str  # the part it plays: secret, identifier or endpoint
    needs: tuple[str, ...] = ()  # roles without which a weak candidate is not reported
    group: int = 0  # the group that the test looks at
    least: int = 0
    has: tuple[str, ...] = ()  # patterns that have to occur in it


# What counts as strong without further parts.
ASSIGN = Kind(
    "assign",
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "secret",
    group=2,
    least=8,
)
# A match is a whole run, so a run that is too short may as well not match.
ACCESS = Kind("access", r"AKIA[A-Z0-9]{12,}", "identifier")
HEX = Kind("hex", r"[0-9a-f]{32,}", "secret")
# Weak candidates: runs that are no news alone, of any length from these on.
KEY = Kind("key", r"[A-Za-z0-9+/_-]{40,}", "secret", ("identifier",), has=("[a-z]", "[A-Z]", "[0-9]"))
ID = Kind("id", r"[A-Z0-9]{20,}", "identifier", ("secret",), has=("[A-Z]", "[0-9]"))
ENDPOINT = Kind(
    "endpoint", r"https?://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+", "endpoint", ("identifier", "secret")
)
BASE = (ASSIGN, ACCESS, HEX)
WEAK = (KEY, ID, ENDPOINT)
KINDS = BASE + WEAK
SCOPE = 256

# Where a span's value begins is ``value``; values end with their spans.
SPANS = "array<struct<start:int,kind:int,end:int,value:int>>"
# Matches whose places are added up at a time.
BLOCK = 256


def spans(text: str, kind: Kind) -> Column:
    """The spans of one kind in code points, end exclusive, in order.

    Matches and what lies between them, in turn, make up the text, so their lengths give the places.
    They are added up in blocks first and the blocks then moved to their places, since each step of
    ``aggregate`` copies what it has found so far.
    """
    pattern = F.lit(kind.pattern)
    matches = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    looked_at = F.regexp_extract_all(F.col(text), pattern, F.lit(kind.group))
    # Pattern and limit go by value; a limit of -1 keeps what follows the last match.
    between = F.split(F.col(text), kind.pattern, -1)
    parts = F.transform(
        F.arrays_zip(
            F.slice(between, 1, F.size(matches)).alias("between"),
            matches.alias("match"),
            looked_at.alias("part"),
        ),
        lambda x: F.struct(
            F.char_length(x["between"]).alias("before"),
            F.char_length(x["match"]).alias("length"),
            F.char_length(x["part"]).alias("value"),
            _passes(x["part"], kind).alias("good"),
        ),
    )

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["before"]
        end = begin + x["length"]
        span = _span(begin, F.lit(KINDS.index(kind)), end, end - x["value"])
        found = F.when(x["good"], F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def moved(state: Column, block: Column) -> Column:
        by = state["at"]
        there = F.transform(
            block["found"],
            lambda s: _span(s["start"] + by, s["kind"], s["end"] + by, s["value"] + by),
        )
        return F.struct(
            (by + block["at"]).alias("at"), F.concat(state["found"], F.array(there)).alias("found")
        )

    def placed(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")),
            lambda b: F.aggregate(F.slice(parts, b * BLOCK + 1, BLOCK), start, step),
        )
        first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("found"))
        return F.aggregate(blocks, first, moved, lambda state: F.flatten(state["found"]))

    # By way of an array of one, so that the parts are worked out once and not for each block.
    found = F.get(F.transform(F.array(parts), placed), 0)
    return F.when(F.col(text).rlike(kind.pattern), found).otherwise(F.array().cast(SPANS))


def _span(start: Column, kind: Column, end: Column, value: Column) -> Column:
    return F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"), value.alias("value"))


def _passes(part: Column, kind: Kind) -> Column:
    good = F.char_length(part) >= kind.least
    for pattern in kind.has:
        good = good & part.rlike(pattern)
    return good


def as_text(found: str) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(found),
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak spans with all the parts they need, apart from them and within ``scope`` code points.

    An interval join over bins as wide as the scope. A part after a candidate begins in the scope
    that begins with the candidate's end, a part before it ends in the scope that ends with the
    candidate's beginning; either scope touches two bins. As matches of one kind don't overlap and have eight code
    points at least, a bin has few of them, however many the text has.

    An identifier and a secret that are apart exist if the least end of the ones is not
    beyond the last beginning of the others, or the other way round.
    """
    key = ["text_hash", "text_check"]
    roles = F.array(*[F.lit(kind.role) for kind in KINDS])
    sides = lambda after, before: F.explode(F.array(F.struct(*after), F.struct(*before)))
    present = (
        parts.withColumn("role", F.get(roles, F.col("kind")))
        .where(F.col("role") != "endpoint")
        .withColumn(
            "side",
            sides(
                [F.lit(0).alias("side"), F.col("value").alias("at")],
                [F.lit(1).alias("side"), F.col("end").alias("at")],
            ),
        )
        .select(*key, "role", "side.*", F.col("value").alias("first"), F.col("end").alias("last"))
        .withColumn("bin", F.floor(F.col("at") / scope))
    )
    weak = (
        parts.where(F.col("kind") >= len(BASE))
        .withColumn(
            "side",
            sides(
                [F.lit(0).alias("side"), F.col("end").alias("low")],
                [F.lit(1).alias("side"), (F.col("value") - scope).alias("low")],
            ),
        )
        .select(*key, "start", "kind", "end", "value", "side.*")
        .withColumn("_bin", F.floor(F.col("low") / scope))
        .withColumn("bin", F.explode(F.array("_bin", F.col("_bin") + 1)))
    )

    def of(role: str, column: str) -> Column:
        return F.when(F.col("role") == role, F.col(column))

    met = (
        weak.join(present, [*key, "side", "bin"])
        .where(F.col("at").between(F.col("low"), F.col("low") + scope))
        .groupBy(*key, "start", "kind", "end", "value")
        .agg(
            F.min(of("identifier", "last")).alias("id_last"),
            F.max(of("identifier", "first")).alias("id_first"),
            F.min(of("secret", "last")).alias("secret_last"),
            F.max(of("secret", "first")).alias("secret_first"),
        )
    )
    confirmed = {
        ("identifier",): F.col("id_last").isNotNull(),
        ("secret",): F.col("secret_last").isNotNull(),
        ("identifier", "secret"): (F.col("id_last") <= F.col("secret_first"))
        | (F.col("secret_last") <= F.col("id_first")),
    }
    good = F.lit(False)
    for kind in WEAK:
        good = good | ((F.col("kind") == KINDS.index(kind)) & confirmed[kind.needs])
    return met.where(good).select(*key, "start", "kind", "end", "value")


def scan(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE
) -> DataFrame:
    """(doc_id, base, spans) for every row: arrays of (start, kind, end), ``kind`` indexing KINDS.

    ``base`` has the strong finds, ``spans`` the weak ones as well that are confirmed: a key by an
    identifier within ``scope`` code points, an identifier by a secret, an endpoint by
    both. Weak parts may confirm each other. The value of a span is the span itself, of an assignment
    what is assigned; distances are between values. A part counts only if its value has
    nothing in common with that of the candidate, and two parts that are needed have nothing in common either.

    The result is a function of the text: copies are linked once. Null texts count as empty;
    null ids, repeated rows and empty tables come out as they are. Other columns are not read.
    """
    found = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        text_or_empty(text).alias("body"),
    ).select(
        "doc_id",
        F.xxhash64("body").alias("text_hash"),
        F.crc32(F.col("body").cast("binary")).alias("text_check"),
        F.concat(*[spans("body", kind) for kind in BASE]).alias("base"),
        F.concat(*[spans("body", kind) for kind in WEAK]).alias("weak"),
    )
    found = saved(found, "secret-spans")
    parts = (
        found.where(F.size("weak") > 0)
        .select("text_hash", "text_check", F.explode(F.concat("base", "weak")).alias("span"))
        .distinct()
        .select("text_hash", "text_check", "span.*")
    )
    linked = saved(
        _linked(parts, scope)
        .groupBy("text_hash", "text_check")
        .agg(F.collect_list(F.struct("start", "kind", "end", "value")).alias("linked")),
        "secret-linked",
    )
    def sorted_spans(found: Column) -> Column:
        return F.transform(
            F.array_sort(found),
            lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
        )

    return found.join(linked, ["text_hash", "text_check"], "left").select(
        "doc_id",
        sorted_spans(F.col("base")).alias("base"),
        sorted_spans(F.concat("base", F.coalesce("linked", F.array().cast(SPANS)))).alias("spans"),
    )


def op5_secrets(spark, sf_dir):
    found = scan(documents(spark, sf_dir))

    def count(kind: Kind) -> Column:
        # A second argument of the function would be the index of the element.
        mine = F.filter("base", lambda s: s["kind"] == KINDS.index(kind))
        return F.size(mine).cast("bigint").alias(f"n_{kind.name}")

    counts = [count(kind) for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans")
    )


# The same result from the rules as said in words, for DuckDB: every kind with its pattern, the
# group that is the value, and its test; candidates meet their parts pair by pair.
_SQL_KINDS = [
    (0, "assign", "secret", 2, "len(g) >= 8",
     r"""(?i)(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)"""),
    (1, "access", "identifier", 0, "len(g) >= 16", "AKIA[A-Z0-9]+"),
    (2, "hex", "secret", 0, "len(g) >= 32", "[0-9a-f]+"),
    (3, "key", "secret", 0,
     "len(g) >= 40 and g ~ '.*[a-z].*' and g ~ '.*[A-Z].*' and g ~ '.*[0-9].*'", "[A-Za-z0-9+/_-]+"),
    (4, "id", "identifier", 0, "len(g) >= 20 and g ~ '.*[A-Z].*' and g ~ '.*[0-9].*'", "[A-Z0-9]+"),
    (5, "endpoint", "endpoint", 0, "true", r"https?://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"),
]


def _spans_sql(k: int, name: str, role: str, group: int, test: str, pattern: str) -> str:
    """The spans of a kind: the sums of lengths, each worked out anew."""
    pattern = pattern.replace("\\'", "''")
    return f"""
        select r, '{name}' as kind, {k} as k, '{role}' as role, s as start, s + len(m) as "end",
               s + len(m) - len(g) as v
        from (
            select r, m, g,
                   list_sum(list_transform(between[1:i], lambda x: len(x)))
                   + coalesce(list_sum(list_transform(found[1 : i - 1], lambda x: len(x))), 0) as s
            from (
                select *, unnest(found) as m, unnest(groups) as g,
                       generate_subscripts(found, 1) as i
                from (
                    select r, regexp_extract_all(body, '{pattern}', 0) as found,
                           regexp_extract_all(body, '{pattern}', {group}) as groups,
                           string_split_regex(body, '{pattern}') as between
                    from doc
                )
            )
        )
        where {test}
    """


def _near_sql(part: str, role: str) -> str:
    """A part of a role apart from the candidate c and within the scope."""
    return f"""{part}.r = c.r and {part}.role = '{role}'
        and ({part}.v between c."end" and c."end" + {SCOPE}
             or {part}."end" between c.v - {SCOPE} and c.v)"""


ORACLE_SQL = f"""
with doc as (select row_number() over () as r, doc_id, coalesce(text, '') as body from documents),
part as materialized ({" union all ".join(_spans_sql(*kind) for kind in _SQL_KINDS)}),
reported as (
    select * from part where k < 3
    union all select * from part c where kind = 'key'
        and exists (select 1 from part i where {_near_sql("i", "identifier")})
    union all select * from part c where kind = 'id'
        and exists (select 1 from part s where {_near_sql("s", "secret")})
    union all select c.* from part c semi join (
        select distinct c.r, c.start from part c
        join part i on {_near_sql("i", "identifier")} join part s on {_near_sql("s", "secret")}
        where c.kind = 'endpoint' and (i."end" <= s.v or s."end" <= i.v)
    ) met on met.r = c.r and met.start = c.start and c.kind = 'endpoint'
),
summed as (
    select r, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access,
        count(*) filter (k = 2) as n_hex,
        string_agg(kind || ':' || cast(start as bigint) || ':' || cast("end" as bigint), ','
                   order by start, k) filter (k < 3) as base,
        string_agg(kind || ':' || cast(start as bigint) || ':' || cast("end" as bigint), ','
                   order by start, k) as spans
    from reported group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
       coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans
from doc left join summed using (r)
"""
