"""The corpus operators' queries: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import (
    embeddings, html, lines, neighbours, online_packing, packing, quality, ranked, sampling, simhash, suffix, warc, whitening,
)
from larder.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": lambda s, d: simhash.op1_simhash(read(s, d, "documents")),
    "op2_packing": lambda s, d: packing.op2_packing(read(s, d, "documents")),
    "op3_html": lambda s, d: html.op3_html(read(s, d, "pages")),
    "op4_sampling": lambda s, d: sampling.op4_sampling(read(s, d, "documents")),
    "op5_lines": lambda s, d: lines.op5_lines(read(s, d, "documents")),
    "op6_suffix": lambda s, d: suffix.op6_suffix(read(s, d, "documents")),
    "op7_embeddings": lambda s, d: embeddings.op7_embeddings(read(s, d, "embeddings")),
    "op8_neighbours": lambda s, d: neighbours.op8_neighbours(read(s, d, "embeddings")),
    "op9_quality": lambda s, d: quality.quality_scores(read(s, d, "documents"), read(s, d, "labels")),
    "op10_warc": lambda s, d: warc.op10_warc(read(s, d, "pages")),
    "op11_whitening": lambda s, d: whitening.op11_whitening(read(s, d, "embeddings")),
    "op12_search": lambda s, d: ranked.op12_search(read(s, d, "documents"), read(s, d, "benchmark")),
    "op13_windows": lambda s, d: online_packing.op13_windows(read(s, d, "documents")),
}

ORACLES: dict[str, str] = {"op10_warc": warc.OP10_SQL, "op12_search": ranked.OP12_SQL}
