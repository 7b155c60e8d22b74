"""Operators for training-data pipelines. Nothing outside imports this package."""

from casebook.llm import ann_blocks, bpe, filter_audit, golay_simhash, html_text, mixing, personal_data, quality_rules, repeat_windows, secret_scan, spelling_variants, topk_columnar, toxicity

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_topk_columnar": topk_columnar.op2_topk_columnar,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_golay_simhash": golay_simhash.op4_golay_simhash,
    "op5_html_text": html_text.op5_html_text,
    "op6_bpe": bpe.op6_bpe,
    "op7_ann_blocks": ann_blocks.op7_ann_blocks,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_mixing": mixing.op9_mixing,
    "op10_repeat_windows": repeat_windows.op10_repeat_windows,
    "op11_spelling_variants": spelling_variants.op11_spelling_variants,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_personal_data": personal_data.op13_personal_data,
}

ORACLE = {
    "op7_ann_blocks": ann_blocks.ORACLE_SQL,
    "op2_topk_columnar": topk_columnar.ORACLE_SQL,
    "op9_mixing": mixing.ORACLE_SQL,
    "op12_filter_audit": filter_audit.ORACLE_SQL,
}
