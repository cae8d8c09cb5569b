"""The queries of this subpackage: name -> callable(spark, sf_dir), and the SQL of those that SQL can express."""

from loomspan.llm.divergence import SQL as DIVERGENCE_SQL
from loomspan.llm.divergence import op12_source_divergence
from loomspan.llm.jaccard import SQL as JACCARD_SQL
from loomspan.llm.jaccard import op4_jaccard_join
from loomspan.llm.langid import op1_language
from loomspan.llm.licences import op2_licences
from loomspan.llm.lines import op8_line_dedup
from loomspan.llm.lloyd import SQL as LLOYD_SQL
from loomspan.llm.lloyd import op11_lloyd
from loomspan.llm.mixing import op7_source_mix
from loomspan.llm.packing import op5_packing
from loomspan.llm.quality import op6_quality
from loomspan.llm.runlength import SQL as REPEATS_SQL
from loomspan.llm.runlength import op10_repeats
from loomspan.llm.sentencepieces import op13_sentencepieces
from loomspan.llm.spans import op9_sentence_spans
from loomspan.llm.topk import SQL as TOPK_SQL
from loomspan.llm.topk import op3_kdtree_topk

QUERIES = {
    "op1_language": op1_language,
    "op2_licences": op2_licences,
    "op3_kdtree_topk": op3_kdtree_topk,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_source_mix": op7_source_mix,
    "op8_line_dedup": op8_line_dedup,
    "op9_sentence_spans": op9_sentence_spans,
    "op10_repeats": op10_repeats,
    "op11_lloyd": op11_lloyd,
    "op12_source_divergence": op12_source_divergence,
    "op13_sentencepieces": op13_sentencepieces,
}

ORACLE_SQL: dict[str, str] = {
    "op3_kdtree_topk": TOPK_SQL,
    "op4_jaccard_join": JACCARD_SQL,
    "op10_repeats": REPEATS_SQL,
    "op11_lloyd": LLOYD_SQL,
    "op12_source_divergence": DIVERGENCE_SQL,
}
