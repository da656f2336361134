"""Find secrets through a trigram inverted index.

Each rule's regular expression yields a Boolean query of trigrams that any match must contain. The index
holds postings (trigram, document) for all trigrams that some rule asks for; a rule's candidates are the
documents in the intersection (and, for alternatives, the union) of its postings. Only candidates are
verified with the expression. A rule without mandatory trigrams is run on every document.

Spark has no function for the positions of all matches: splitting a text by an expression gives what
stands between the matches that extracting gives, so running sums of both lengths are the positions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.llm.text import packed, text_of
from chronolake.session import stored

# Candidates whose keys are broadcast to their texts: at most this many rows of under 200 bytes. More are
# joined by a shuffle.
MAX_BROADCAST = 500_000


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more; shorter ones are used up, too.

    ``fast`` may give an expression with the same kept matches that is cheaper to run.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    fast: str = ""
    any_case: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + (self.fast or self.pattern)


# The base rules, in the order of their kinds.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, fast=r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]+", least=24, fast=r"[0-9a-f]{24,}"),
)

# Further well-known forms of credentials.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("login", r"[a-z]{2,12}://[A-Za-z0-9._-]{1,64}:[^\x20\x09-\x0D/:@]{3,64}@"),
)

RULES = BASE_RULES + MORE_RULES


# --- trigram queries: None (anything), a trigram, or ("and" | "or", parts) ---------------------------


def _both(parts: list) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _either(parts: list) -> object:
    if any(p is None for p in parts):
        return None
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _required(nodes) -> tuple[object, str | None]:
    """The query of a parsed sequence, and its text if it is one fixed string."""
    found, run, fixed = [], "", True

    def close():
        found.extend(run[i : i + 3] for i in range(len(run) - 2))

    for kind, value in nodes:
        name, exact, inner = str(kind), None, None
        if name == "LITERAL":
            exact = chr(value).lower()
        elif name == "SUBPATTERN":
            inner, exact = _required(value[-1])
        elif name == "BRANCH":
            inner = _either([_required(branch)[0] for branch in value[1]])
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            inner, once = _required(value[2])
            exact = once * value[0] if once and value[0] == value[1] else None
        if exact is not None:
            run += exact
            continue
        close()
        run, fixed = "", False
        found.append(inner)
    close()
    return _both(found), run if fixed else None


def trigram_query(pattern: str):
    """Lower-case trigrams that a text with a match must contain; None if there are none."""
    return _required(re._parser.parse(pattern))[0]


def trigrams_of(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _holds(query, present: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(present, query)
    held = [_holds(part, present) for part in query[1]]
    result = held[0]
    for more in held[1:]:
        result = (result & more) if query[0] == "and" else (result | more)
    return result


# --- index, candidates, verification ------------------------------------------------------------


def trigram_postings(docs: DataFrame, trigrams: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Postings (trigram, key) of the given trigrams over every whole text, read in lower case."""
    lower = F.lower(text_of(F.col(f"`{text}`")))
    rows = docs.select(F.col(f"`{key}`").alias("key"), lower.alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return rows.select("key", F.explode(present).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, object]) -> DataFrame:
    """Rows (key, kinds): the rules whose trigram query the key's postings satisfy, if there are any.

    The postings of a key are at most the trigrams of the rules, and are combined before the shuffle.
    """
    present = postings.groupBy("key").agg(F.collect_set("trigram").alias("present"))
    kinds = [F.when(_holds(q, F.col("present")), F.lit(kind)) for kind, q in queries.items()]
    return present.select("key", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


_SPAN = "array<struct<start:int,place:int,kind:string,end:int>>"


# Matches that one accumulator gathers: arrays are copied when they grow, so they are kept short.
BLOCK = 128


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """All kept matches of a rule in a text, as structs that sort by start, then rule.

    Gaps and matches are summed up within blocks, and the blocks are shifted to their places: the work is
    linear in the matches but for one short array for each block.
    """
    pattern = F.lit(rule.java)
    pieces = F.arrays_zip(
        F.transform(F.split(text, rule.java, -1), F.char_length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length).alias("long"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length).alias("part"),
    )

    def step(done: Column, piece: Column) -> Column:
        start = done["at"] + piece["gap"]
        end = start + F.coalesce(piece["long"], F.lit(0))
        span = F.struct(
            start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        # The last gap has no match behind it: its part is null.
        kept = F.when(piece["part"] >= rule.least, F.concat(done["spans"], F.array(span)))
        return F.struct(end.alias("at"), kept.otherwise(done["spans"]).alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def in_blocks(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1)), F.lit(BLOCK))
        return F.transform(starts, lambda at: F.aggregate(F.slice(found, at, F.lit(BLOCK)), none, step))

    def shifted(blocks: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            blocks,
            first,
            lambda done, block: F.struct(
                (done["at"] + block["at"]).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts")
            ),
            lambda done: done["starts"],
        )
        return F.flatten(F.zip_with(blocks, starts, _shift))

    return _bound(_bound(pieces, in_blocks), shifted)


def _shift(block: Column, by: Column) -> Column:
    return F.transform(
        block["spans"],
        lambda s: F.struct(
            (s["start"] + by).alias("start"), s["place"].alias("place"), s["kind"].alias("kind"), (s["end"] + by).alias("end")
        ),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    rules: tuple[Rule, ...] = RULES,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """All secrets of every whole text.

    Returns one row for each row of ``docs``: ``key`` and ``spans``, an array of (start, place, kind, end)
    ordered by start, then by the order of ``rules``; positions are code points, the end is exclusive.

    Null and empty texts have no spans. Rows that share an id (or have none) share their candidate rules;
    each row's own text is verified. Repeated rows stay repeated, an empty table gives an empty result,
    further columns are ignored whatever their names.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: q for kind, q in queries.items() if q is not None}
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(F.col(f"`{text}`")).alias("text"))
    if indexed:
        wanted = sorted(set().union(*map(trigrams_of, indexed.values())))
        found = stored(candidates(trigram_postings(docs, wanted, text, key), indexed), "secret-candidates")
        found = found.withColumnRenamed("key", "c_key")
        small = found.count() <= max_broadcast
        rows = rows.join(F.broadcast(found) if small else found, F.col("key").eqNullSafe(F.col("c_key")), "left")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    nothing = F.array().cast(_SPAN)
    spans = []
    for place, rule in enumerate(rules):
        if rule.kind in indexed:
            wanted_here = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:
            wanted_here = F.col("text").rlike(rule.java)
        spans.append(F.when(wanted_here, _spans(F.col("text"), rule, place)).otherwise(nothing))
    return rows.select(F.col("key").alias(key), F.array_sort(F.concat(*spans)).alias("spans"))


def secret_digest(found: DataFrame, key: str = "doc_id", base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts of each base kind, the digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    kinds = [rule.kind for rule in base]

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    basic = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return found.select(
        key,
        *map(count, kinds),
        F.sha2(_joined(basic).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def with_secrets_masked(docs: DataFrame, mask: str = "*", text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with every secret's characters replaced; each row is masked by its own text's spans."""
    rows = docs.select(packed(docs).alias("row"))
    whole = F.col(f"row.`{text}`")
    nothing = F.array().cast(_SPAN)
    found = [F.when(text_of(whole).rlike(r.java), _spans(text_of(whole), r, i)).otherwise(nothing) for i, r in enumerate(RULES)]
    rows = rows.select("row", F.array_sort(F.concat(*found)).alias("spans"))

    def cover(done: Column, span: Column) -> Column:
        size = span["end"] - span["start"]
        return F.overlay(done, F.repeat(F.lit(mask), size), span["start"] + 1, size)

    masked = F.coalesce(F.aggregate("spans", whole, cover), whole)
    return rows.select([masked.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
