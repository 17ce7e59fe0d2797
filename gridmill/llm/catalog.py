"""The queries of the corpus operators and the SQL that some of them have."""

from gridmill.llm import decontaminate, exact_dedup, language, merkle, packing, pieces, quality, rules, secrets, simhash, substrings, toxicity, whitening

QUERIES = {
    "op1_suffix_dedup": substrings.op1_suffix_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_secrets": secrets.op4_secrets,
    "op5_quality": quality.op5_quality,
    "op6_packing": packing.op6_packing,
    "op7_sentencepiece": pieces.op7_sentencepiece,
    "op8_rules": rules.op8_rules,
    "op9_language": language.op9_language,
    "op10_simhash": simhash.op10_simhash,
    "op11_whitening": whitening.op11_whitening,
    "op12_merkle": merkle.op12_merkle,
    "op13_decontamination": decontaminate.op13_decontamination,
}

ORACLES = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op4_secrets": secrets.OP4_SQL,
    "op8_rules": rules.OP8_SQL,
    "op12_merkle": merkle.OP12_SQL,
    "op13_decontamination": decontaminate.OP13_SQL,
}
