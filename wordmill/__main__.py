"""Run a job on text files: ``spark-submit`` this module or ``python -m wordmill JOB``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

import wordmill as W
from wordmill.session import session
from wordmill.sources import articles, sinks
from wordmill.sources.text import read_lines


def run(spark: SparkSession, job: str, source: str, sort: bool = False) -> DataFrame:
    """The rendered result of a job on the text files at ``source``.

    ``sort`` puts articles in the order of their files; other jobs are sorted when written.
    """
    if job == "articles":
        found = articles.read_articles(spark, source)
        return found.orderBy("file", "article_no").select("article") if sort else found.select("article")
    lines = read_lines(spark, source)
    if job == "word-count":
        return sinks.render_counts(W.word_count(lines))
    if job == "pmi-pairs":
        return sinks.render_pmi_pairs(W.pmi_pairs(lines))
    if job == "pmi-ranked":
        return sinks.render_pmi_pairs(W.pmi_ranked(W.pmi_pairs(lines)))
    if job == "pmi-stripes":
        return sinks.render_stripes(W.pmi_stripes(lines), "word")
    if job == "bigram-pairs":
        return sinks.render_bigram_pairs(W.bigram_relfreq_pairs(lines))
    return sinks.render_stripes(W.bigram_relfreq_stripes(lines), "w1")


JOBS = [
    "word-count",
    "pmi-pairs",
    "pmi-ranked",
    "pmi-stripes",
    "bigram-pairs",
    "bigram-stripes",
    "articles",
]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="wordmill", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input", required=True, help="input path")
    parser.add_argument("--output", required=True, help="output path, overwritten")
    parser.add_argument("--reducers", type=int, help="number of part files at most")
    parser.add_argument("--sort", action="store_true", help="write rows in key order")
    args = parser.parse_args(argv)
    if args.job == "pmi-ranked" and (args.reducers or args.sort):
        parser.error("pmi-ranked is written in rank order; it takes neither --reducers nor --sort")
    rendered = run(session(), args.job, args.input, args.sort)
    if args.job == "pmi-ranked" or (args.job == "articles" and args.sort):  # already in order
        rendered.write.mode("overwrite").text(args.output)
    else:
        sinks.write_text(rendered, args.output, args.reducers, args.sort)


if __name__ == "__main__":
    main()
