"""Corpus statistics as Spark DataFrame jobs: word counts, PMI, bigrams, articles."""

from wordmill.operators.cooccurrence import count_cooccurrence, count_pairs, count_word_sets, merge_counts, merge_word_sets
from wordmill.operators.counts import line_frequency, line_total, word_count
from wordmill.operators.lines import split_lines
from wordmill.operators.stripes import merge_stripes, normalised_stripes, supported_stripes
from wordmill.plans.bigrams import (
    bigram_count_stripes,
    bigram_counts,
    bigram_grouping_sets,
    bigram_marginals,
    bigram_relfreq_pairs,
    bigram_relfreq_stripes,
)
from wordmill.plans.pmi import (
    pair_count_stripes,
    pair_counts,
    pair_stripes_from_counts,
    pairs_from_counts,
    pmi_pairs,
    pmi_ranked,
    pmi_stripes,
    pmi_top,
    stripes_from_counts,
)

__all__ = [
    "bigram_count_stripes",
    "bigram_counts",
    "bigram_grouping_sets",
    "bigram_marginals",
    "bigram_relfreq_pairs",
    "bigram_relfreq_stripes",
    "count_cooccurrence",
    "count_pairs",
    "count_word_sets",
    "line_frequency",
    "line_total",
    "merge_counts",
    "merge_stripes",
    "merge_word_sets",
    "normalised_stripes",
    "pair_count_stripes",
    "pair_counts",
    "pair_stripes_from_counts",
    "pairs_from_counts",
    "pmi_pairs",
    "pmi_ranked",
    "pmi_stripes",
    "pmi_top",
    "split_lines",
    "stripes_from_counts",
    "supported_stripes",
    "word_count",
]
