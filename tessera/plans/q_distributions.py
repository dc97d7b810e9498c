"""Queries: score distributions (R1-R4, W3), colour statistics (R5, W2), file
listing and audits (S15, R6, J9) and batch scoring (M14), over ``embeddings``
and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import distributions as R
from ..session import scratch_path, spread
from ..sources.manifest import manifest, with_content, write_objects
from .registry import query, r6, r6sql, table


def _counts(col, start):
    return F.transform(F.slice(col, start, 10), lambda x: F.floor(F.abs(x.cast("double")) * 100) + 1)


def _ratings(spark, sf_dir):
    """10-bin vote counts from the first ten embedding values, and a second
    distribution from the next ten (the 'prediction')."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", R.normalise(_counts(F.col("embedding"), 1)).alias("scores"),
                    R.normalise(_counts(F.col("embedding"), 11)).alias("pred"))


RATINGS_SQL = """WITH r AS (SELECT vec_id, unnest(range(1, 11)) AS i,
    unnest(list_transform(embedding[1:10], lambda x: floor(abs(CAST(x AS DOUBLE)) * 100) + 1)) AS c,
    unnest(list_transform(embedding[11:20], lambda x: floor(abs(CAST(x AS DOUBLE)) * 100) + 1)) AS c2
  FROM embeddings),
p AS (SELECT vec_id, i, c / sum(c) OVER (PARTITION BY vec_id) AS p,
    c2 / sum(c2) OVER (PARTITION BY vec_id) AS q FROM r),
m AS (SELECT vec_id, sum(p * i) AS mean FROM p GROUP BY vec_id),
cd AS (SELECT vec_id, i, p, sum(p) OVER (PARTITION BY vec_id ORDER BY i) AS cp,
    sum(q) OVER (PARTITION BY vec_id ORDER BY i) AS cq FROM p),
per_row AS (SELECT m.vec_id, m.mean, sqrt(sum(cd.p * (cd.i - m.mean) * (cd.i - m.mean))) AS std,
    sqrt(avg((cd.cp - cd.cq) * (cd.cp - cd.cq))) AS emd
  FROM cd JOIN m ON cd.vec_id = m.vec_id GROUP BY m.vec_id, m.mean)
"""


@query("rating_scores", "R1 R2 R3 R4 W3 S16",
       oracle=RATINGS_SQL + f"""SELECT vec_id, {r6sql('mean')} AS mean, {r6sql('std')} AS std,
  {r6sql('emd')} AS emd FROM per_row""")
def q_rating_scores(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    return r.select("vec_id", r6(R.mean_score("scores")).alias("mean"),
                    r6(R.std_score("scores")).alias("std"), r6(R.emd("scores", "pred")).alias("emd"))


@query("emd_loss", "R4", oracle=RATINGS_SQL + f"SELECT {r6sql('avg(emd)')} AS emd FROM per_row")
def q_emd_loss(spark, sf_dir):
    return R.emd_loss(_ratings(spark, sf_dir), "scores", "pred").select(r6("emd").alias("emd"))


def _level(x, scale):
    return F.least(F.floor(F.abs(x.cast("double")) * (24 * scale)), F.lit(7)) * 36


def _pixels(spark, sf_dir):
    """Pixels from embeddings: image = vec_id, half = position >= 32, three
    channels quantised from the value at three scales."""
    e = table(spark, sf_dir, "embeddings")
    px = e.select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("pos", "x"))
    return px.select("image_id", (F.col("pos") >= 32).cast("int").alias("half"),
                     _level(F.col("x"), 1.0).alias("r"), _level(F.col("x"), 1.25).alias("g"),
                     _level(F.col("x"), 1.1).alias("b"))


def _level_sql(scale):
    return f"least(floor(abs(CAST(x AS DOUBLE)) * {24 * scale}), 7) * 36"


COLOUR_SQL = f"""WITH px AS (SELECT vec_id AS image_id, CAST(pos >= 32 AS INTEGER) AS half,
    {_level_sql(1.0)} AS r, {_level_sql(1.25)} AS g, {_level_sql(1.1)} AS b
  FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM embeddings)),
cnt AS (SELECT image_id, half, r, g, b, count(*) AS n FROM px GROUP BY image_id, half, r, g, b),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, half
    ORDER BY n DESC, r, g, b) AS rk FROM cnt) WHERE rk <= 25),
ph AS (SELECT image_id, half,
    sum(CASE WHEN r >= 240 AND g >= 240 AND b >= 240 THEN n ELSE 0 END) * CAST(100 AS DOUBLE) / sum(n) AS light,
    sum(CASE WHEN r <= 20 AND g <= 20 AND b <= 20 THEN n ELSE 0 END) * CAST(100 AS DOUBLE) / sum(n) AS dark
  FROM top GROUP BY image_id, half)
SELECT image_id, CASE WHEN count(*) = 2 THEN {r6sql('avg(light)')} END AS light_percent,
  CASE WHEN count(*) = 2 THEN {r6sql('avg(dark)')} END AS dark_percent FROM ph GROUP BY image_id"""


@query("colour_stats", "R5 W2", oracle=COLOUR_SQL)
def q_colour(spark, sf_dir):
    c = R.colour_stats(_pixels(spark, sf_dir), digits=None)
    return c.select("image_id", r6("light_percent").alias("light_percent"),
                    r6("dark_percent").alias("dark_percent"))


@query("colour_stats_rounded", "R5",
       oracle=COLOUR_SQL.replace("AS light,\n", "AS light0,\n").replace(
           "AS dark\n  FROM top", "AS dark0,\n    round_even(light0, 2) AS light, round_even(dark0, 2) AS dark\n  FROM top"))
def q_colour_rounded(spark, sf_dir):
    """Each half's percentages rounded to two digits before their mean."""
    c = R.colour_stats(_pixels(spark, sf_dir))
    return c.select("image_id", r6("light_percent").alias("light_percent"),
                    r6("dark_percent").alias("dark_percent"))


def _page_files(spark, sf_dir):
    """Each page as a file of its own, many in each of sixteen folders, and their manifest."""
    path = scratch_path(spark, "pages")
    pages = table(spark, sf_dir, "pages")
    name = F.concat_ws("/", F.col("page_id") % 16, F.concat(F.col("page_id").cast("string"), F.lit(".HTML")))
    write_objects(spread(pages.select(name.alias("name"), "html"), "name"), path, "name", "html")
    files = manifest(spark, path, [".html"])
    return files.withColumn("page_id", F.regexp_extract("path", r"/(\d+)\.HTML$", 1).cast("long"))


@query("file_listing", "S15 S16 P16", oracle="SELECT page_id, CAST(strlen(html) AS BIGINT) AS length FROM pages")
def q_listing(spark, sf_dir):
    return _page_files(spark, sf_dir).select("page_id", "length")


@query("unreadable_files", "R6",
       oracle=r"""SELECT page_id, CAST(strlen(html) AS BIGINT) AS length FROM pages
WHERE NOT (starts_with(html, '<!DOCTYPE html>') AND ends_with(regexp_replace(html, '\s+$', ''), '</html>'))""")
def q_unreadable(spark, sf_dir):
    files = _page_files(spark, sf_dir)
    bad = R.signature_audit(with_content(files), b"<!DOCTYPE html>", b"</html>")
    return bad.join(files.select("path", "page_id"), "path").select("page_id", "length")


@query("rows_with_files", "J9",
       oracle="SELECT vec_id, label FROM embeddings WHERE vec_id % 7 <> 0")
def q_present(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "images")
    # every 7th image is missing on disk
    name = F.concat(F.col("vec_id").cast("string"), F.lit(".jpg"))
    write_objects(spread(e.where(F.col("vec_id") % 7 != 0).select(name.alias("name"), F.col("label").cast("string").alias("label")),
                         "name"), path, "name", "label")
    listing = manifest(spark, path, [".png", ".jpg", ".jpeg"]).select(
        F.regexp_extract("path", r"/(\d+)\.jpg$", 1).cast("long").alias("vec_id"))
    return R.present(e.select("vec_id", "label"), listing, "vec_id")


def _head_sql() -> str:
    k_terms = []
    for k in range(10):
        w = ", ".join(str(((((k + 1) * (j + 3)) % 7) - 3) / 10.0) for j in range(64))
        k_terms.append(f"list_sum(list_transform(list_zip(e, [{w}]), lambda t: t[1] * t[2])) AS l{k}")
    return ("WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e "
            "FROM embeddings),\nl AS (SELECT vec_id, " + ", ".join(k_terms) + " FROM x),\n"
            "u AS (SELECT vec_id, unnest(range(1, 11)) AS i, unnest([" +
            ", ".join(f"l{k}" for k in range(10)) + "]) AS logit FROM l),\n"
            "p AS (SELECT vec_id, i, exp(logit - max(logit) OVER (PARTITION BY vec_id)) AS z FROM u),\n"
            "q AS (SELECT vec_id, i, z / sum(z) OVER (PARTITION BY vec_id) AS p FROM p),\n"
            "m AS (SELECT vec_id, sum(p * i) AS mean FROM q GROUP BY vec_id)\n"
            f"SELECT m.vec_id, {r6sql('m.mean')} AS mean, "
            f"{r6sql('sqrt(sum(q.p * (q.i - m.mean) * (q.i - m.mean)))')} AS std "
            "FROM q JOIN m ON q.vec_id = m.vec_id GROUP BY m.vec_id, m.mean")


@query("batch_scoring", "M14 R2 R3", oracle=_head_sql())
def q_batch(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    s = R.batch_score(e, "vec_id", "embedding", R.linear_softmax_head(64))
    return s.select("vec_id", r6("mean").alias("mean"), r6("std").alias("std"))
