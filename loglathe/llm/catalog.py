"""The registered queries of this subpackage and their SQL."""

from . import (
    decontaminate, exact_dedup, id_store, language, line_dedup, near_dup, packing, periodic, quality, sharding, spelling, toxicity, warc
)

QUERIES = {
    "op1_noisy_or_toxicity": toxicity.op1_noisy_or_toxicity,
    "op2_line_windows": line_dedup.op2_line_windows,
    "op3_shortest_pack_first": packing.op3_shortest_pack_first,
    "op4_family_language": language.op4_family_language,
    "op5_co_trained_quality": quality.op5_co_trained_quality,
    "op6_two_level_index": warc.op6_two_level_index,
    "op7_content_sort": exact_dedup.op7_content_sort,
    "op8_bbit_minhash": near_dup.op8_bbit_minhash,
    "op9_hash_tree_shards": sharding.op9_hash_tree_shards,
    "op10_template_decontamination": decontaminate.op10_template_decontamination,
    "op11_multiscale_minimizers": periodic.op11_multiscale_minimizers,
    "op12_perfect_hash_ids": id_store.op12_perfect_hash_ids,
    "op13_pivotal_grams": spelling.op13_pivotal_grams,
}
# The others need a tokenizer, a trained model, template rules or all lags of a text.
ORACLE = {
    "op2_line_windows": line_dedup.OP2_SQL,
    "op6_two_level_index": warc.OP6_SQL,
    "op7_content_sort": exact_dedup.OP7_SQL,
    "op8_bbit_minhash": near_dup.OP8_SQL,
    "op9_hash_tree_shards": sharding.OP9_SQL,
    "op13_pivotal_grams": spelling.OP13_SQL,
}
