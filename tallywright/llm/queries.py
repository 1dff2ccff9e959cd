"""All registered queries of this subpackage."""

import corpus_pipeline
from tallywright.llm import alignment, classifier, collocations, jaccardjoin, languages, mixing, neardup, neighbours, packing, quality_rules, resharding, secrets, tokenfiles  # noqa: F401
from tallywright.llm.common import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
