"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from musterline.llm.ann_prefix_forest import op4_ann_prefix_forest
from musterline.llm.byte_bpe import op3_byte_bpe
from musterline.llm.decontamination import op2_benchmark_decontamination
from musterline.llm.language_id import op7_language_id
from musterline.llm.lexical_search import OP11_SQL, op11_lexical_search
from musterline.llm.license_scan import op5_license_scan
from musterline.llm.merkle_manifest import OP12_SQL, op12_merkle_manifest
from musterline.llm.ngram_jaccard_join import op1_ngram_jaccard_join
from musterline.llm.piece_bpe import op13_sentencepiece
from musterline.llm.pii import op6_pii
from musterline.llm.quality_classifier import op8_quality_classifier
from musterline.llm.toxicity import op10_toxicity
from musterline.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_ann_prefix_forest": op4_ann_prefix_forest,
    "op5_license_scan": op5_license_scan,
    "op6_pii": op6_pii,
    "op7_language_id": op7_language_id,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_lexical_search": op11_lexical_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_sentencepiece": op13_sentencepiece,
}
ORACLE: dict[str, str] = {"op9_warc": OP9_SQL, "op11_lexical_search": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
