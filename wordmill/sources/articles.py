"""One-line articles from dumps whose articles stand between tag lines.

A line with a start tag opens an article and is dropped, even if it also has an end tag. Any
other line with an end tag closes the article and is dropped. A closed article is its lines,
each followed by one blank; an article that is never closed does not come out. Closing does
not forget: if a second end tag follows without a start tag in between, the article comes out
again with the lines that were added. Articles do not reach across files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordmill.sources.checkpoints import materialise

# The two tags.
START_TAG = r"<doc[^>]*>"
END_TAG = "</doc>"


def read_dump(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of dump files with their place: ``file, block, pos, value``.

    A large file is read in splits by many tasks. ``block`` is where a split starts and ``pos``
    grows within it, so the two order the lines of a file without reading it in one task. Both
    come straight off the scan, so reading a split again gives the same values.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.regexp_replace("value", r"\r\z", "").alias("value"),
    )


def _tagged(lines: DataFrame) -> DataFrame:
    opens = F.col("value").rlike(START_TAG)
    closes = ~opens & F.contains("value", F.lit(END_TAG))
    tag = F.when(opens, F.lit("start")).when(closes, F.lit("end"))
    return lines.select("file", "block", "pos", "value", tag.alias("tag"))


def _with_blank(line: Column) -> Column:
    return F.concat(line["value"], F.lit(" "))


def fragments(lines: DataFrame) -> DataFrame:
    """What each block alone says of its articles: one row per stretch of lines up to an end tag.

    ``file, block, opened, ended, closed, earlier, text``: the stretch comes after ``opened`` start
    tags and ``ended`` end tags of its block, and ``closed`` says whether an end tag of the block
    follows its ``text``. ``earlier`` is the text of the stretches before it since the same start
    tag, empty but for articles that are closed twice. Stretches that no start tag of their block
    precedes are its head, those after its last start tag are its tail; all others are whole
    articles or lost. The lines are read once and shuffled once.
    """
    tagged = _tagged(lines)
    so_far = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_end = F.coalesce(F.col("tag") == "end", F.lit(False))
    stretches = tagged.select(
        "file",
        "block",
        F.count_if(F.col("tag") == "start").over(so_far).alias("opened"),
        # An end tag belongs to the stretch it closes.
        (F.count_if(F.col("tag") == "end").over(so_far) - is_end.cast("long")).alias("ended"),
        is_end.alias("is_end"),
        F.when(F.col("tag").isNull(), F.struct("pos", "value")).alias("line"),
    )
    folded = stretches.groupBy("file", "block", "opened", "ended").agg(
        F.bool_or("is_end").alias("closed"),
        F.array_join(F.transform(F.sort_array(F.collect_list("line")), _with_blank), "").alias("text"),
    )
    before = Window.partitionBy("file", "block", "opened").orderBy("ended").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.array_join(F.collect_list("text").over(before), "")
    return folded.select("file", "block", "opened", "ended", "closed", earlier.alias("earlier"), "text")


def _blocks(kept: DataFrame) -> DataFrame:
    """Tags of each block and what the blocks before and after it say; one row per block.

    Sums of tags and the first tag that follows are all that blocks have to tell each other, so
    one short row per block goes through the windows over a file.
    """
    head_closed = F.bool_or((F.col("opened") == 0) & (F.col("ended") == 0) & F.col("closed"))
    blocks = kept.groupBy("file", "block").agg(
        F.max("opened").alias("starts"), F.count_if("closed").alias("ends"), head_closed.alias("head_closed")
    )
    first_tag = F.when(F.col("head_closed"), F.lit("end")).when(F.col("starts") > 0, F.lit("start"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        "file",
        "block",
        "starts",
        F.coalesce(F.sum("starts").over(before), F.lit(0)).alias("starts_before"),
        F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("ends_before"),
        F.last(first_tag, ignorenulls=True).over(after).alias("tag_after"),
    )


def merged_articles(kept: DataFrame) -> DataFrame:
    """Articles of kept fragments: ``file, article_no, article``.

    An article whose start and end tag lie in one block is ready; only heads and tails of blocks
    that an article reaches across are shuffled, one article at a time.
    """
    article_no = F.col("ends_before") + F.col("ended") + 1
    placed = kept.join(_blocks(kept), ["file", "block"])
    whole = placed.where((F.col("opened") > 0) & F.col("closed")).select(
        "file", article_no.alias("article_no"), F.concat("earlier", "text").alias("article")
    )

    goes_on = F.coalesce(F.col("tag_after") == "end", F.lit(False))
    is_head = (F.col("opened") == 0) & (F.col("closed") | ((F.col("starts") == 0) & goes_on))
    is_tail = (F.col("opened") > 0) & (F.col("opened") == F.col("starts")) & goes_on
    pieces = (
        placed.where(is_head | is_tail)
        .groupBy("file", (F.col("starts_before") + F.col("opened")).alias("start_no"), article_no.alias("article_no"))
        .agg(
            F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"),
            F.bool_or((F.col("opened") == 0) & F.col("closed")).alias("shown"),
        )
        .withColumn("piece", F.array_join(F.col("parts.text"), ""))
    )
    so_far = Window.partitionBy("file", "start_no").orderBy("article_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = pieces.withColumn("article", F.array_join(F.collect_list("piece").over(so_far), ""))
    return whole.unionByName(joined.where("shown").select("file", "article_no", "article"))


def assemble_articles(lines: DataFrame) -> DataFrame:
    """Articles of numbered lines ``file, block, pos, value``: ``file, article_no, article``.

    Each block is folded into fragments by itself, and fragments are kept. No task ever holds a
    file; lines are collected one article at a time.
    """
    return merged_articles(materialise(fragments(lines), "fragments"))


def read_articles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Articles of any dump files: ``file, article_no, article``."""
    return assemble_articles(read_dump(spark, path))


def read_well_formed_articles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Articles of well-formed dump files, without a shuffle: ``file, article``.

    Well-formed means that both tags stand alone on their lines and every article is closed.
    Each end tag then ends one record of the scan, wherever the splits of a file fall.
    """
    records = spark.read.option("lineSep", END_TAG).text(path)
    # Everything up to the last start tag's line is not part of the article.
    body = F.regexp_extract("value", rf"(?s)\A.*{START_TAG}\r?\n(.*)\z", 1)
    article = F.replace(F.replace(body, F.lit("\r\n"), F.lit("\n")), F.lit("\n"), F.lit(" "))
    return records.where(F.col("value").rlike(START_TAG)).select(
        F.col("_metadata.file_path").alias("file"), article.alias("article")
    )
