"""Versioned instructions and request templates of the two external work items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import ingest
from .taxonomy import Taxonomy, stable_json

VERSION = "1"
PILOT = "Read the samples and propose which kinds of things deserve a category of their own. Quote evidence verbatim, from two samples or more for each proposal, and say why a reader needs it. Answer with one JSON object."
EXTRACTION = "Extract the entities, claims, relationships, passages and open questions of the segment. Use only the taxonomy's categories, attributes, relations and passage kinds. Every excerpt must be an exact quotation. Answer with one JSON object."
PILOT_REQUEST = "Profile: {{PROFILE}}\n\nTaxonomy: {{TAXONOMY}}\n\nSamples:\n\n{{SAMPLES}}"


def pilot_item(segments: DataFrame, taxonomy: Taxonomy, profile: str, samples: int = 6, directory: str = "work") -> DataFrame:
    """(path, content): one work item over the sampled segments, long ones in thirds."""
    rows = ingest.stratified(segments, samples)
    one = F.concat(F.lit("--- "), "id", F.lit(" | "), "title", F.lit(" ---\n"), X.pilot_sample(F.col("text")))
    told = rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sourceId", "ordinal", one.alias("t")))), lambda s: s["t"]), "\n\n").alias("samples"))
    request = X.fill_template(PILOT_REQUEST, {"PROFILE": profile, "TAXONOMY": stable_json(taxonomy.value())})
    before, _, after = request.partition("{{SAMPLES}}")
    content = F.concat(F.lit(f"# Taxonomy pilot work item\n\n## Instructions\n\n{PILOT}\n\n## Request\n\n{before}"), "samples", F.lit(f"{after}\n"))
    return told.select(F.lit(f"{directory}/taxonomy-pilot.md").alias("path"), content.alias("content"))
