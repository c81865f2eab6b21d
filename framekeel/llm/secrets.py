"""Secrets in texts: strong patterns by themselves, weak ones only next to the parts that complete a credential.

Strong kinds are ``assign``, ``access`` and ``hex``. Weak kinds are ``id`` (a named account or key), ``key`` (a
run of letters and digits) and ``endpoint`` (a URL or IPv4 address). Each kind has a role: access identifier,
secret or endpoint. The scope of a part is the part itself and ``REACH`` code points before and after it: a weak
identifier is reported if a secret reaches into its scope, a weak secret if an identifier does, an endpoint if both
do, so parts that stand side by side are linked however long they are. A weak span that overlaps a strong one is
dropped.

The parts of a document meet in an interval join: the text is cut into bins as wide as the reach, a part lies in
all bins that it covers, and of each role the first and last covered place is kept per bin. A candidate looks into
the bins of its scope. In the first and last of them the nearest place decides, and any place in a bin between, so
this is exact, and a document full of parts makes a few rows a candidate. Positions count code points; they are
running sums of the lengths that ``split`` and ``regexp_extract_all`` give for one pattern. Texts stay in the task
that reads them, and each pattern takes time in proportion to the text, whatever the text.

A null text counts as empty and has no spans; very long texts are searched whole. Repeated rows and null or repeated
ids are rows of their own; other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, staged, text_of

#: Kinds in the order in which spans of one start are listed.
STRONG = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
}
WEAK = {
    "id": r"""(?i:user(?:name)?|login|account|client_?id|key_?id|access_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}""",
    "key": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}={0,2}",
    "endpoint": r"""(?i:https?|ftp|ssh|(?:jdbc:)?(?:mysql|mariadb|postgres|postgresql|sqlserver|oracle|db2|mssql)"""
    r"""|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""
    r"""|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])""",
}
KINDS = [*STRONG, *WEAK]
ROLES = {"assign": "secret", "hex": "secret", "key": "secret", "access": "access", "id": "access", "endpoint": "endpoint"}
#: An assignment counts if the assigned value has so many characters.
ASSIGNED = 8
#: Code points from the end of a part to the start of the next one that is still in its scope.
REACH = 256


def _found(kind: str, pattern: str) -> Column:
    """Lengths of the gaps before matches, of the matches, and of assigned values; the last gap has no match."""
    text = F.col("text")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind == "assign" else 0))

    def lengths(parts: Column) -> Column:
        return F.transform(parts, lambda x: F.length(x))

    zipped = F.arrays_zip(
        lengths(F.split(text, pattern, -1)).alias("gap"), lengths(matches).alias("size"), lengths(values).alias("value")
    )
    rows = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("turn"),
            x["gap"].alias("gap"),
            x["size"].alias("size"),
            x["value"].alias("value"),
        ),
    )
    empty = F.array().cast("array<struct<kind:string,turn:int,gap:int,size:int,value:int>>")
    # Most texts have no match of a kind: they are searched once and never split.
    return F.when(text.rlike(pattern), F.filter(rows, lambda x: x["size"].isNotNull())).otherwise(empty)


def _parts(docs: DataFrame) -> DataFrame:
    """One row per match, with its bounds; a document without any has one row without kind."""
    rows = numbered(docs.select("doc_id", text_of().alias("text")))
    found = F.concat(*(_found(kind, pattern) for kind, pattern in {**STRONG, **WEAK}.items()))
    rows = rows.select("row_id", "doc_id", F.explode_outer(found).alias("part"))
    rows = staged(rows.select("row_id", "doc_id", "part.*"), "parts")
    order = Window.partitionBy("row_id", "kind").orderBy("turn")
    end = F.sum(F.col("gap") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    # A failing match keeps its row, so that its document does.
    failing = (F.col("kind") == "assign") & (F.col("value") < ASSIGNED)
    rows = rows.withColumn("kind", F.when(~failing, F.col("kind")))
    names = F.array(*(F.lit(k) for k in KINDS))
    rows = rows.withColumn("kind_no", F.array_position(names, F.col("kind")) - 1)
    return rows.withColumn("strong", F.col("kind").isin(*STRONG))


def _clear(parts: DataFrame) -> DataFrame:
    """Parts without the weak ones that overlap a strong one."""
    order = Window.partitionBy("row_id").orderBy("start", F.col("strong").desc(), "kind_no")
    before = F.max(F.when(F.col("strong"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("strong"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    marked = parts.withColumn("before", before).withColumn("after", after)
    apart = (F.coalesce(F.col("before"), F.lit(-1)) <= F.col("start")) & (
        F.coalesce(F.col("after"), F.col("end")) >= F.col("end")
    )
    return marked.where(F.col("strong") | apart).select("row_id", "kind", "kind_no", "start", "end", "strong")


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """Weak parts whose complement reaches into their scope."""
    role = F.element_at(F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair)), F.col("kind"))
    parts = parts.withColumn("role", role)

    def bins_from(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / reach), F.floor(last / reach))).alias("bin")

    covered = parts.select("row_id", "role", "start", "end", bins_from(F.col("start"), F.col("end")))
    low = F.greatest("start", F.col("bin") * reach)
    high = F.least("end", F.col("bin") * reach + reach - 1)
    ends = [
        fold(F.when(F.col("role") == r, place)).alias(f"{name}_{r}")
        for r in ("access", "secret")
        for name, fold, place in (("first", F.min, low), ("last", F.max, high))
    ]
    bins = covered.groupBy("row_id", "bin").agg(*ends)
    begin, finish = F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach
    weak = parts.where("NOT strong").withColumns({"begin": begin, "finish": finish})
    met = weak.select("*", bins_from(F.col("begin"), F.col("finish"))).join(bins, ["row_id", "bin"])

    def in_scope(role: str) -> Column:
        # A scope is wider than a bin, so it begins and ends in different ones, unless it begins with the text.
        inside = (F.col(f"last_{role}") >= F.col("begin")) & (F.col(f"first_{role}") <= F.col("finish"))
        return F.max(F.coalesce(inside, F.lit(False))).alias(f"by_{role}")

    links = met.groupBy("row_id", "kind", "kind_no", "start", "end", "strong", "role").agg(
        in_scope("access"), in_scope("secret")
    )
    needs = {"access": "by_secret", "secret": "by_access", "endpoint": "by_access AND by_secret"}
    complete = " OR ".join(f"(role = '{r}' AND {need})" for r, need in needs.items())
    return links.where(complete).select(*(c for c in parts.columns if c != "role"))


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``row_id``, ``doc_id`` and ``spans`` (start, kind_no, kind, end, strong) in order, of every row."""
    parts = staged(_parts(docs), "spans")
    clear = staged(_clear(parts.where("kind IS NOT NULL")), "clear-spans")
    spans = clear.where("strong").unionByName(_linked(clear, reach))
    span = F.struct("start", "kind_no", "kind", "end", "strong")
    none = parts.select("row_id", "doc_id").distinct()
    own = spans.groupBy("row_id").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(own.schema["spans"].dataType)
    return none.join(own, "row_id", "left").withColumn("spans", F.coalesce("spans", empty))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
