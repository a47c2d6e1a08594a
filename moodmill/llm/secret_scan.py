"""Secret scans: spans in texts, and who else in the corpus owns the same value.

Every pattern is scanned with built-in functions: ``regexp_extract_all`` gives the matches and
``split`` on the same pattern the stretches between them. Matches become rows, and running sums over the rows of
a text give the places in code points, so the work is linear in the matches of a text. Candidates are the base
kinds (``assign``, ``access``, ``hex``) and ``bare``: long runs that mix upper case, lower case and digits, and that touch
no base span.

The values are hashed and, over the whole corpus, counted by distinct owner and repository. A value
found with ``WIDE`` owners or in ``WIDE_REPOSITORIES`` repositories or more, though they be of one owner, is a widely
copied example. A value of one owner in fewer repositories that looks live (long enough, with digits and letters) is a
credential of that owner. A bare run is reported only if it is such a credential; base spans are always reported.

Defined results: a null text is an empty one; a null owner or repository counts as one of its own, apart from an
empty one; repeated rows are judged one by one, and rows that share a key too; a text without matches has no spans and
the digest of an empty string; a very long text is scanned whole, and its matches, not the text, are what is
sorted; ties (spans with the same start) are listed by kind; an empty table gives an empty table; other columns, whatever
their names, are not read by ``report`` and come back unchanged from ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmill.functions.binding import let
from moodmill.storage import materialise

#: The base patterns, in the order in which kinds are listed.
ASSIGN = (
    "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: A bare candidate: a long run with an upper case letter, a lower case letter and a digit.
BARE = "[A-Za-z0-9+/_-]{20,}"

KINDS = ("assign", "access", "hex", "bare")
#: Characters that the value of an assignment needs.
LEAST_VALUE = 6
#: Owners from which on a value is a widely copied example.
WIDE = 3
#: Repositories from which on it is one, whoever owns them.
WIDE_REPOSITORIES = 4
#: Characters that a value needs to look live.
LIVE_LENGTH = 12

_FOUND = "array<struct<kind:int,place:int,gap:int,found:string>>"


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """The matches of one pattern in order, each with the length of the stretch before it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(
        F.slice(gaps, 1, F.size(found)), found, lambda gap, match: F.struct(gap.alias("gap"), match.alias("found"))
    )
    numbered = F.transform(
        pairs,
        lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), p["gap"].alias("gap"), p["found"].alias("found")),
    )
    return F.when(text.rlike(pattern), numbered).otherwise(F.array().cast(_FOUND))


def scan(docs: DataFrame, owner: Column, repository: Column, text: str = "text") -> DataFrame:
    """The stored columns of ``docs`` with ``_rid``, ``_owner``, ``_repository`` and ``_found``, all matches of a row.

    The one pass over the texts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    patterns = enumerate((ASSIGN, ACCESS, HEX, BARE))

    def named(value: Column) -> Column:
        # Apart from an empty name, which a null is not.
        return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))

    return docs.select(
        "*",
        F.monotonically_increasing_id().alias("_rid"),
        named(owner).alias("_owner"),
        named(repository).alias("_repository"),
        F.concat(*(_matches(body, kind, pattern) for kind, pattern in patterns)).alias("_found"),
    )


def spans(scanned: DataFrame) -> DataFrame:
    """``_rid, _owner, _repository, start, kind, stop, value``: base spans, and bare runs that touch none of them."""
    rows = scanned.filter(F.size("_found") > 0).select("_rid", "_owner", "_repository", F.inline("_found"))
    # A text's matches meet once; both orders below keep to that.
    met = rows.repartition("_rid")
    so_far = Window.partitionBy("_rid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.length("found")).over(so_far).cast("int")
    value = F.when(F.col("kind") == 0, F.regexp_extract("found", ASSIGN, 2)).otherwise(F.col("found"))
    placed = met.select("*", stop.alias("stop"), value.alias("value")).withColumn("start", F.col("stop") - F.length("found"))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    good = F.when(F.col("kind") == 0, F.length("value") >= LEAST_VALUE).when(F.col("kind") == 3, mixed).otherwise(True)
    known = placed.filter(good)

    base = F.col("kind") < 3
    before = Window.partitionBy("_rid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("_rid").orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.when(base, F.col("stop"))).over(before)
    coming = F.min(F.when(base, F.col("start"))).over(behind)
    touched = (F.coalesce(reached, F.lit(0)) > F.col("start")) | (F.coalesce(coming, F.col("stop")) < F.col("stop"))
    apart = known.withColumn("touched", touched).filter(base | ~F.col("touched"))
    return apart.select("_rid", "_owner", "_repository", "start", "kind", "stop", "value")


def looks_live(value: Column) -> Column:
    return (F.length(value) >= LIVE_LENGTH) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def ownership(candidates: DataFrame) -> DataFrame:
    """``h, n_owners, n_repositories, verdict`` of each value hash.

    Equal (value, owner, repository) rows are merged in each task before they travel.
    """
    pairs = candidates.select("h", "_owner", "_repository", "_live").distinct()
    counted = pairs.groupBy("h").agg(
        F.count_distinct("_owner").alias("n_owners"),
        F.count_distinct("_repository").alias("n_repositories"),
        F.max("_live").alias("_live"),
    )
    wide = (F.col("n_owners") >= WIDE) | (F.col("n_repositories") >= WIDE_REPOSITORIES)
    verdict = F.when(wide, "example").when((F.col("n_owners") == 1) & F.col("_live"), "live").otherwise("shared")
    return counted.select("h", "n_owners", "n_repositories", verdict.alias("verdict"))


def judged(scanned: DataFrame) -> DataFrame:
    """``_rid, start, kind, stop, n_owners, n_repositories, verdict`` of all candidates in a stored scan."""
    hashed = spans(scanned).select("*", F.sha2("value", 256).alias("h"), looks_live(F.col("value")).alias("_live"))
    candidates = materialise(hashed.drop("value"), "secret-spans")
    # Stored: the join by value hash could not split a common value above its own aggregation.
    owners = materialise(ownership(candidates), "secret-owners")
    return candidates.drop("_owner", "_repository", "_live").join(owners, "h").drop("h")


def is_reported(span: Column) -> Column:
    """Base spans always; bare runs that are credentials of one owner."""
    return (span["kind"] < 3) | (span["verdict"] == "live")


def listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    one = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")
        ),
    )
    return F.concat_ws(",", one)


def report(docs: DataFrame, owner: Column, repository: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans, verdict counts, and how far values are spread.

    ``most_repositories`` is the largest number of repositories that hold one of its values.
    """
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), owner.alias("_o"), repository.alias("_r"))
    scanned = scan(narrow, F.col("_o"), F.col("_r"), "_text").drop("_text", "_o", "_r")
    stored = materialise(scanned, "secret-scan")
    span = F.struct("start", "kind", "stop", "verdict", "n_repositories")
    found = judged(stored).groupBy("_rid").agg(F.sort_array(F.collect_list(span)).alias("_spans"))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,verdict:string,n_repositories:bigint>>")
    all_spans = F.coalesce("_spans", none)
    rows = stored.select("_rid", "_key").join(found, "_rid", "left").select("_key", all_spans.alias("_spans"))

    def count(test) -> Column:
        return F.size(F.filter("_spans", test)).cast("long")

    def of_kind(kind: int) -> Column:
        return count(lambda s: s["kind"] == kind).alias(f"n_{KINDS[kind]}")

    return rows.select(
        F.col("_key").alias(key),
        *(of_kind(kind) for kind in range(3)),
        F.sha2(listed(F.filter("_spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        listed(F.filter("_spans", is_reported)).alias("spans"),
        count(lambda s: s["verdict"] == "live").alias("n_live"),
        count(lambda s: s["verdict"] == "example").alias("n_example"),
        F.coalesce(F.array_max(F.transform("_spans", lambda s: s["n_repositories"])), F.lit(0)).cast("long").alias("most_repositories"),
    )


def redact(
    docs: DataFrame, owner: str | Column, repository: str | Column, text: str = "text", mark: str = "[secret]"
) -> DataFrame:
    """All rows and columns of ``docs``; values other than widely copied examples give way to ``mark``.

    Texts are scanned once and stored with what was found; rows without a match pass unchanged. Overlapping spans are
    replaced once.
    """
    # Columns get names of their own; owner and repository are read before that.
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    who, where = (F.col(c) if isinstance(c, str) else c for c in (owner, repository))
    bound = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], who.alias("_o"), where.alias("_r"))
    body_name = names[text]
    stored = materialise(scan(bound, F.col("_o"), F.col("_r"), body_name).drop("_o", "_r"), "secret-scan")
    own = [F.col(n) for n in names.values()]

    hidden = judged(stored).filter((is_reported(F.struct("kind", "verdict"))) & (F.col("verdict") != "example"))
    order = Window.partitionBy("_rid").orderBy("start", "stop")
    at = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Of what lies between the spans, pieces that touch have no length; a span inside another has no mark of its own.
    cut = hidden.select("_rid", "start", "stop", at.alias("at"))
    piece = F.struct("start", "stop", "at")
    cuts = cut.groupBy("_rid").agg(F.sort_array(F.collect_list(piece)).alias("_cuts"), F.max("stop").alias("_end"))

    def between(bytes_: Column, begin: Column, end: Column) -> Column:
        taken = F.substring(bytes_, begin * 4 + 1, F.greatest(end - begin, F.lit(0)) * 4)
        return F.decode(F.concat(F.unhex(F.lit("0000FEFF")), taken), "UTF-32")

    def without(wide: Column) -> Column:
        pieces = F.transform(
            "_cuts",
            lambda c: F.concat(
                between(wide, c["at"], c["start"]), F.when(c["start"] >= c["at"], F.lit(mark)).otherwise(F.lit(""))
            ),
        )
        return F.concat(F.array_join(pieces, ""), between(wide, F.col("_end"), F.length(body_name)))

    matched = stored.filter(F.size("_found") > 0).join(cuts, "_rid", "left")
    # Four bytes a character, so that a piece is taken without counting characters from the start.
    cleaned = let(F.encode(F.col(body_name), "UTF-32"), without)
    changed = F.when(F.col("_cuts").isNull(), F.col(body_name)).otherwise(cleaned)
    rebuilt = matched.select(*[changed.alias(n) if n == body_name else F.col(n) for n in names.values()])
    rows = stored.filter(F.size("_found") == 0).select(*own).unionByName(rebuilt)
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])
