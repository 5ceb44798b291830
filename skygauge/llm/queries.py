"""Named queries of the corpus operators, and SQL that states their results where SQL can."""

from skygauge.llm import ann, chat, embdedup, langid, minhash, packing, phrases, pieces, quality, secrets, suffix, toxicity, whitening

QUERIES = {
    "op1_language_id": langid.op1,
    "op2_packing": packing.op2,
    "op3_suffix_dedup": suffix.op3,
    "op4_chat": chat.op4,
    "op5_sentencepiece": pieces.op5,
    "op6_minhash": minhash.op6,
    "op7_nearest": ann.op7,
    "op8_quality": quality.op8,
    "op9_toxicity": toxicity.op9,
    "op10_embedding_dedup": embdedup.op10,
    "op11_secrets": secrets.op11,
    "op12_phrases": phrases.op12,
    "op13_whitening": whitening.op13,
}

ORACLES: dict[str, str] = {
    "op4_chat": chat.ORACLE,
    "op6_minhash": minhash.ORACLE,
    "op10_embedding_dedup": embdedup.ORACLE,
    "op12_phrases": phrases.ORACLE,
}
