"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from barlake.llm import (
    chat_format, decontaminate, dual_tree_search, jaccard_join, license_scan, minhash_join, source_divergence, voronoi_knn,
)
from barlake.llm.chat_format import op4_chat_formatting
from barlake.llm.decontaminate import op10_decontaminate
from barlake.llm.dual_tree_search import op13_dual_tree_search
from barlake.llm.jaccard_join import op6_ngram_jaccard_join
from barlake.llm.kneser_ney import op2_kneser_ney_scoring
from barlake.llm.license_scan import op9_license_scan
from barlake.llm.minhash_join import op12_minhash_join
from barlake.llm.mix_sources import op7_pareto_mixing
from barlake.llm.pii import op3_weakly_supervised_pii
from barlake.llm.source_divergence import op11_source_divergence
from barlake.llm.toxicity import op8_toxicity_nearest_examples
from barlake.llm.voronoi_knn import op5_voronoi_knn
from barlake.llm.wrapper_induction import op1_wrapper_induction

QUERIES = {
    f.__name__: f
    for f in (
        op1_wrapper_induction,
        op2_kneser_ney_scoring,
        op3_weakly_supervised_pii,
        op4_chat_formatting,
        op5_voronoi_knn,
        op6_ngram_jaccard_join,
        op7_pareto_mixing,
        op8_toxicity_nearest_examples,
        op9_license_scan,
        op10_decontaminate,
        op11_source_divergence,
        op12_minhash_join,
        op13_dual_tree_search,
    )
}

ORACLE = {
    "op4_chat_formatting": chat_format.ORACLE_SQL,
    "op5_voronoi_knn": voronoi_knn.ORACLE_SQL,
    "op6_ngram_jaccard_join": jaccard_join.ORACLE_SQL,
    "op9_license_scan": license_scan.ORACLE_SQL,
    "op10_decontaminate": decontaminate.ORACLE_SQL,
    "op11_source_divergence": source_divergence.ORACLE_SQL,
    "op12_minhash_join": minhash_join.ORACLE_SQL,
    "op13_dual_tree_search": dual_tree_search.ORACLE_SQL,
}
