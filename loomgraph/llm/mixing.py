"""Operator 9: mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Sources in code-point order (null last) weigh 5, 2, 1, 5, ...; they share 150 % of all words by weight, none more than twice its own words, the
excess going to the others by weight. That is a water level: a source gets min(2 * size, level * weight), and sorted sums over the table of
sources find the level. A source's target is whole epochs of all its documents first, then a sample: each document has the key -ln(u) / quality,
u from md5 of its id, and the documents of the smallest keys are taken whole while their running sum stays within what is left; later passes do
the same with the documents not taken that still fit, so that the mix comes near its target without cutting a document.

Running sums of a source are not made in one task: keys fall into 2^14 bins of exp(-key), sums of bins are summed first, and only inside a bin
are single documents. The table of sources is one row for each source.

Nulls: a null text has size 0, a null id the empty string as its id, a null source is a source. Rows of one id have one key; ties go by id, then
size, then at will (equal rows). Sizes of 0 are taken 0 times. Very long texts are one document. Only the three named columns are read. An empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

BINS = 1 << 14
#: Words per word of input, the cap of a source in its own words, weights by rank.
SHARE, CAP, WEIGHTS = 1.5, 2, (5, 2, 1)
PASSES = 3


def quality_weight(text: Column) -> Column:
    """0.25 to 1: less for texts with many of the symbols # * $ % & | < >."""
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    return F.lit(0.25) + F.lit(0.75) * (F.lit(1.0) - F.least(F.lit(1.0), F.lit(4.0) * symbols / (F.length(text) + 1)))


def uniform(id_text: Column, seed: str) -> Column:
    """In (0, 1), from 48 bits of md5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), id_text)), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target of a table of documents' source and size; a row for each source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", level)
    # the first source that the level leaves below its limit sets the level for all after it
    found = per.withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("limit"), F.struct(F.col("limit") / F.col("w"), "level"))).over(whole)["level"])
    return found.select("source", "source_size", F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("w"), F.col("limit"))).alias("target"))


#: A table of sources is broadcast if it is counted and has no more rows.
MOST_BROADCAST = 100_000


def _with_sources(rows: DataFrame, sources: DataFrame, on) -> DataFrame:
    """rows joined with a row for each source; a table too large to broadcast is joined by key, and the rows dealt anew by bin, so that no source stays in one task."""
    if sources.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        return rows.join(F.broadcast(sources), on)
    return rows.join(sources, on).repartition("source_no", "bin")


def _pass(rows: DataFrame, budget: str, name: str) -> DataFrame:
    """rows with the boolean column `name`: documents that are free, fit, and whose running sum by key stays within the source's budget."""
    able = F.col("free") & (F.col("size") > 0) & (F.col("size") <= F.col(budget))
    able_size = F.when(able, F.col("size")).otherwise(0)
    bins = rows.groupBy("source_no", "bin").agg(F.sum(able_size).alias("bin_size"))
    before = Window.partitionBy("source_no").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("source_no", "bin", F.coalesce(F.sum("bin_size").over(before), F.lit(0)).alias("bin_from"))
    inside = Window.partitionBy("source_no", "bin").orderBy("key", "doc", "size", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("bin_from") + F.sum(able_size).over(inside)
    return rows.join(bins, ["source_no", "bin"]).withColumn(name, able & (upto <= F.col(budget))).drop("bin_from")


def mix(docs: DataFrame, seed: str = "mix", passes: int = PASSES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken; row_col: a column of unique numbers of rows, which comes along, so that each row of one id has its own decision."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    key = -F.log(uniform(doc, seed)) / quality_weight(text)
    rows = docs.select(F.col(id_col).alias("id"), doc.alias("doc"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(common.WORD)).cast("long").alias("size"), key.alias("key"), *([] if row_col is None else [F.col(row_col).alias("row")]))
    rows = rows.withColumn("bin", (F.lit(BINS - 1) - F.floor(F.exp(-F.col("key")) * BINS)).cast("int"))
    if row_col is None:
        rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = common.written(rows, "mix")
    targets = source_targets(rows)
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = targets.withColumn("left", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    targets = common.written(targets.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))), "targets")
    placed = _with_sources(rows, targets, rows["source"].eqNullSafe(targets["source"])).select("id", "doc", "size", "key", "bin", "row", "source_no", "source_size", "target", "epochs", "left")
    placed = placed.withColumn("free", F.lit(True)).withColumn("chosen", F.lit(False))
    for step in range(passes):
        placed = _pass(placed, "left", "now")
        placed = placed.withColumn("chosen", F.col("chosen") | F.col("now")).withColumn("free", F.col("free") & ~F.col("now"))
        placed = common.written(placed, "mix")
        if step + 1 < passes:
            spent = placed.groupBy("source_no").agg(F.sum(F.when(F.col("now"), F.col("size")).otherwise(0)).alias("spent"))
            placed = _with_sources(placed.drop("now"), common.written(spent, "spent"), "source_no").withColumn("left", F.col("left") - F.col("spent")).drop("spent")
    taken = F.col("size") * (F.col("epochs") + F.col("chosen").cast("int"))
    return placed.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.cast("long").alias("taken"), *([] if row_col is None else [F.col("row").alias(row_col)]))


def oracle(seed: str = "mix", passes: int = PASSES) -> str:
    """The same in SQL, with plain running sums."""
    sql = f"""
    with sized as (
      select doc_id, coalesce(cast(doc_id as varchar), '') as doc, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
        -ln((cast(('0x' || substr(md5('{seed}|' || coalesce(cast(doc_id as varchar), '')), 1, 12)) as bigint)::double + 0.5) / {float(1 << 48)})
        / (0.25 + 0.75 * (1.0 - least(1.0, 4.0 * (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g'))) / (length(coalesce(text, '')) + 1)))) as key
      from documents),
    per as (
      select source, sum(size)::bigint as source_size, [{", ".join(f"{float(x)}" for x in WEIGHTS)}][1 + (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)}]::double as w
      from sized group by source),
    lim as (select *, source_size * {float(CAP)} as lim, sum(source_size) over () as total from per),
    lev as (
      select *, ({SHARE} * total - coalesce(sum(lim) over (order by lim / w, source nulls last rows between unbounded preceding and 1 preceding), 0))
        / sum(w) over (order by lim / w, source nulls last rows between current row and unbounded following) as level from lim),
    lvl as (select min(level) as level from lev where level * w <= lim),
    tgt as (
      select source, source_size, least(lim, coalesce((select arg_min(level, lim / w) from lev where level * w <= lim) * w, lim)) as target from lev),
    epo as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as epochs from tgt),
    p0 as (
      select s.*, t.source_size, t.target, t.epochs, floor(t.target - t.epochs * t.source_size)::bigint as gap, false as chosen
      from sized s join epo t on s.source is not distinct from t.source)"""
    for i in range(1, passes + 1):
        sql += f""",
    q{i} as (
      select *, not chosen and size > 0 and size <= gap as able, sum(case when not chosen and size > 0 and size <= gap then size else 0 end)
        over (partition by source order by key, doc, size rows between unbounded preceding and current row) as upto from p{i - 1}),
    p{i} as (
      select doc_id, doc, source, size, key, source_size, target, epochs,
        (gap - sum(case when able and upto <= gap then size else 0 end) over (partition by source))::bigint as gap, chosen or (able and upto <= gap) as chosen from q{i})"""
    return sql + f"""
    select doc_id, size::bigint as size, source_size, target, (size * (epochs + chosen::int))::bigint as taken from p{passes}"""


def mixed_rows(docs: DataFrame, decisions: DataFrame, row_col: str) -> DataFrame:
    """docs, each row as often as the mix takes it; decisions of mix() with the same row_col, which goes."""
    copies = decisions.filter("taken > 0").select(F.col(row_col).alias("row"), (F.col("taken") / F.col("size")).cast("int").alias("copies"))
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != row_col]).alias("given")  # so that no name of theirs meets another
    taken = docs.select(F.col(row_col).alias("row"), given).join(copies, "row")
    return taken.select("given", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("given.*")
