"""JSON arrays of objects in files of any size, read by many tasks.

A file is cut at its closing braces, which Spark's text reader does in byte ranges, one block of the file
to a task. Whether a brace closes an element depends on all that stands before it: whether it lies in a quoted text,
and how many objects are open. Both are sums, so each block is summed up by itself, for either
case of a quoted text that may reach into it; prefix sums over the blocks then say how each one begins. A piece that begins
and ends between elements is an element; pieces of elements that hold further braces are put together by their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorstream.session import new_folder

PLACE = ("file", "block", "at")


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(value, file): the text of every object in the arrays of ``path``, as it is written.

    A file holds one array of objects, or several values one after the other. The text stands from the element's opening
    brace to its closing one. Anything else between the elements than commas, brackets and white space stops the
    job, and so does a file that ends within an element. Empty arrays and files have no rows.
    """
    pieces = (
        spark.read.option("lineSep", "}")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("file_size"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters
    outside = F.regexp_replace(plain, r'"[^"]*("|$)', "")
    inside = F.regexp_replace(F.regexp_replace(plain, r'^[^"]*("|$)', ""), r'"[^"]*("|$)', "")
    counted = pieces.select(
        "*",
        _count(plain, '"').alias("quotes"),
        _count(outside, "{").alias("opened_outside"),
        _count(inside, "{").alias("opened_inside"),
    )
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = F.sum("quotes").over(before)
    # Quoted or not, as if the block began outside a text; the other case is the opposite throughout.
    begins, ends = F.pmod(marks - F.col("quotes"), F.lit(2)), F.pmod(marks, F.lit(2))

    def change(flip: int) -> Column:
        opened = F.when(begins == flip, F.col("opened_outside")).otherwise(F.col("opened_inside"))
        return opened - F.when(ends == flip, 1).otherwise(0)

    summed = (
        counted.withColumn("change_0", change(0))
        .withColumn("change_1", change(1))
        .withColumn("depth_0", F.sum("change_0").over(before))
        .withColumn("depth_1", F.sum("change_1").over(before))
        .withColumn("octets", F.octet_length("value") + 1)
        .select(*PLACE, "value", "quotes", "octets", "file_size", "change_0", "change_1", "depth_0", "depth_1")
    )
    folder = new_folder(spark, "array-pieces")
    summed.write.parquet(folder)
    summed = spark.read.schema(summed.schema).parquet(folder)
    # A few numbers for each block: what it adds, and then how it begins.
    totals = [F.sum(c).alias(c) for c in ("quotes", "octets", "change_0", "change_1")]
    blocks = summed.groupBy("file", "block").agg(
        *totals, F.max("file_size").alias("file_size"), F.max("at").alias("last_at")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    blocks = blocks.withColumn("flip", F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2)))
    change_of = F.when(F.col("flip") == 0, F.col("change_0")).otherwise(F.col("change_1"))
    # What stands behind the last brace of a file is a piece that no brace ends.
    is_last = F.col("block") == F.max("block").over(whole)
    open_ended = F.sum("octets").over(whole) != F.col("file_size")
    blocks = blocks.select(
        "file",
        "block",
        "flip",
        F.coalesce(F.sum(change_of).over(earlier), F.lit(0)).alias("depth"),
        F.when(is_last & open_ended, F.col("last_at")).alias("tail_at"),
    )
    placed = summed.join(blocks, ["file", "block"])
    own = F.when(F.col("flip") == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
    delta = F.when(F.col("flip") == 0, F.col("change_0")).otherwise(F.col("change_1"))
    placed = placed.withColumn("after", F.col("depth") + own).withColumn("before", F.col("after") - delta)
    placed = placed.withColumn("tail", F.col("at").eqNullSafe(F.col("tail_at")))
    placed = placed.select(*PLACE, "value", "before", "after", "tail")
    within = (F.col("before") != 0) | (F.col("after") != 0)
    single = placed.where(~within & ~F.col("tail")).select("value", "file", F.lit(False).alias("wrong"))
    rest = placed.where(within & ~F.col("tail")).withColumn("ends", (F.col("after") == 0).cast("int"))
    # Elements in pieces, by how many such have ended before; again block by block.
    ended = rest.groupBy("file", "block").agg(F.sum("ends").alias("n"))
    ended = ended.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ended"))
    so_far = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    numbered = rest.withColumn("own", F.coalesce(F.sum("ends").over(so_far), F.lit(0))).join(ended, ["file", "block"])
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value", "after"))).alias("parts")
    joined = (
        numbered.groupBy("file", (F.col("ended") + F.col("own")).alias("number"))
        .agg(parts)
        .select(
            F.array_join(F.transform("parts", lambda p: p["value"]), "}").alias("value"),
            "file",
            (F.element_at("parts", -1)["after"] != 0).alias("wrong"),
        )
    )
    # The tail closed one object too many, if it is not within a text; it may hold no other.
    bare = (F.col("before") == 0) & (F.col("after") == -1)
    tails = placed.where("tail").select("value", "file", (~bare).alias("wrong"))
    elements = single.unionByName(joined).unionByName(tails)
    opening = F.instr("value", "{")
    between = F.when(opening > 0, F.substring("value", F.lit(1), opening - 1)).otherwise(F.col("value"))
    wrong = F.col("wrong") | ~between.rlike(r"^[\s\[\],]*$")
    text = F.concat(F.substring("value", opening, F.length("value")), F.lit("}"))
    stopped = F.raise_error(F.concat(F.lit("no array of objects: "), F.col("file")))
    # In a generator, so that no filter takes the check to pieces that are not elements.
    checked = F.when(wrong, F.array(stopped.cast("string"))).when(opening > 0, F.array(text))
    return elements.select(F.explode(checked).alias("value"), "file")


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))
