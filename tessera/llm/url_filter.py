"""URL filters: explicit rules first, then a path-template tree per host.

Rules are ``(verdict, "host/path")``; a rule fits its host and all subdomains, if
the URL's path starts with the rule's; the longest fitting rule decides. The URLs
that a rule decides are the labelled examples of the tree.

The tree grows level by level over distinct (host, path) pairs with their counts,
by aggregations alone, so a host with a third of all URLs is many rows in many
tasks. At each level, under each template so far, the next path segments are

* generalised: segments with mostly digits (or a long hexadecimal run) become
  ``*`` (an extension stays); so do rare ones (``rare`` URLs at most) among more
  than ``siblings`` different segments;
* merged: literal siblings whose labelled block rate does not differ from the
  rate of all labelled siblings (two-proportion z below ``z_limit``) become one
  branch ``{+}``; siblings without labels become ``{?}``. A branch that differs
  stays apart.

A template is rejected if its smoothed block rate ``(blocked + strength * prior) /
(labelled + strength)`` is at least ``reject``. A template without labels backs off to
its nearest ancestor with some: ``prior + share * (rate - prior)``, where ``rate`` is the
ancestor's smoothed rate and ``share`` the part of its URLs that are labelled. So the rest
of a host whose pages are nearly all labelled and blocked is rejected; one section of
many that a rule blocks says little of the others. Paths below ``levels`` segments end
in ``**``.

Defined results: a null URL or one without ``://`` has an empty host and path and
no rule; it is judged by the empty template. Repeated rows get equal verdicts.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as ``struct(verdict, rule)`` (null: none). ``rules``
    is a short list; it becomes part of the plan."""
    found = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        out = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        found = F.when(fits, out) if found is None else found.when(fits, out)
    none = F.lit(None).cast("struct<verdict:string,rule:string>")
    return none if found is None else found.otherwise(none)


def _shape(segment: Column) -> Column:
    """The segment, or ``*`` and its extension if it looks generated."""
    name = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    digits = F.regexp_count(name, F.lit("[0-9]"))
    made = (2 * digits >= F.length(name)) & (digits > 0) | F.rlike(name, F.lit("^[0-9a-f-]{12,}$"))
    return F.when(made, F.concat(F.lit("*"), segment.substr(F.length(name) + 1, F.length(segment)))).otherwise(segment)


def templates(paths: DataFrame, levels: int = 4, siblings: int = 20, rare: int = 2,
              z_limit: float = 1.96) -> DataFrame:
    """Template of every row of ``paths`` (distinct ``host, path`` with ``n`` URLs,
    ``labelled`` and ``blocked`` ones): adds ``template`` and the counts of the nearest
    ancestor with labels, ``up_n, up_labelled, up_blocked`` (0: none has)."""
    counts = ("n", "labelled", "blocked")
    state = paths.withColumn("template", F.lit("")).withColumn(
        "rest", F.regexp_replace("path", "^/", "")).withColumns({f"up_{c}": F.lit(0).cast("long") for c in counts})
    for _ in range(levels):
        segment = _shape(F.substring_index("rest", "/", 1))
        more = F.length("rest") > 0
        state = state.withColumn("segment", F.when(more, segment)).withColumn(
            "rest", F.when(F.locate("/", F.col("rest")) > 0, F.substring(
                F.col("rest"), F.locate("/", F.col("rest")) + 1, F.length("rest"))).otherwise(F.lit("")))
        node = ["host", "template"]
        child = (state.where("segment IS NOT NULL").groupBy(*node, "segment")
                 .agg(*[F.sum(c).alias(f"c_{c}") for c in counts]))
        total = child.groupBy(*node).agg(
            F.count(F.lit(1)).alias("children"), *[F.sum(f"c_{c}").alias(f"t_{c}") for c in counts])
        rate, own = F.col("t_blocked") / F.col("t_labelled"), F.col("c_blocked") / F.col("c_labelled")
        spread = F.sqrt(rate * (1 - rate) * (1 / F.col("c_labelled") + 1 / F.col("t_labelled")))
        alike = F.when(spread > 0, F.abs(own - rate) / spread < z_limit).otherwise(own == rate)
        branch = (F.when(F.startswith("segment", F.lit("*")), F.col("segment"))
                  .when((F.col("children") > siblings) & (F.col("c_n") <= rare), F.lit("*"))
                  .when(F.col("c_labelled") == 0, F.lit("{?}"))
                  .when(alike, F.lit("{+}")).otherwise(F.col("segment")))
        names = child.join(total, node).select(*node, "segment", branch.alias("branch"), *[f"t_{c}" for c in counts])
        state = state.join(names, [*node, "segment"], "left")
        known = F.col("t_labelled") > 0
        state = state.withColumns({
            "template": F.when(F.col("branch").isNotNull(), F.concat_ws("/", "template", "branch")).otherwise(F.col("template")),
            **{f"up_{c}": F.when(known, F.col(f"t_{c}")).otherwise(F.col(f"up_{c}")) for c in counts},
        }).drop("branch", "segment", *[f"t_{c}" for c in counts])
        state = stage(state, "templates")
    deep = F.length("rest") > 0
    return state.withColumn("template", F.when(deep, F.concat("template", F.lit("/**"))).otherwise(
        F.col("template"))).drop("rest")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                levels: int = 4, prior: float = 0.1, strength: float = 4.0, reject: float = 0.5) -> DataFrame:
    """Verdict of every URL: ``id_col, host, path, rule, verdict, template``."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("r", rule_for(F.col("host"), F.col("path"), rules))
    paths = rows.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("r.verdict").alias("labelled"),
        F.count_if(F.col("r.verdict") == "block").alias("blocked"))
    placed = templates(paths, levels)
    def rate(blocked: str, labelled: str) -> Column:
        return (F.col(blocked) + F.lit(strength * prior)) / (F.col(labelled) + F.lit(strength))

    share = F.col("up_labelled") / F.when(F.col("up_n") > 0, F.col("up_n"))
    back_off = F.coalesce(F.lit(prior) + share * (rate("up_blocked", "up_labelled") - F.lit(prior)), F.lit(prior))
    judged = placed.groupBy("host", "template").agg(
        F.sum("labelled").alias("l"), F.sum("blocked").alias("b"),
        *[F.max(f"up_{c}").alias(f"up_{c}") for c in ("n", "labelled", "blocked")]).select(
        "host", "template", (F.when(F.col("l") > 0, rate("b", "l")).otherwise(back_off) >= reject).alias("rejected"))
    verdicts = placed.join(judged, ["host", "template"]).select("host", "path", "template", "rejected")
    return (rows.join(verdicts, ["host", "path"])
            .select(id_col, "host", "path", F.col("r.rule").alias("rule"), F.coalesce(
                "r.verdict", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                "template"))
