"""The registered queries of this package and, where SQL can state them, their DuckDB counterparts."""

import corpus_pipeline
from strata.llm import chat, decontamination, html_text, lexical, resampling
from strata.llm.chat import op7_chat_formatting
from strata.llm.decontamination import op2_decontamination
from strata.llm.html_text import op5_html_text
from strata.llm.lexical import op12_lexical_search
from strata.llm.line_dedup import op4_line_dedup
from strata.llm.mixing import op9_mixing
from strata.llm.quality_model import op1_quality
from strata.llm.quality_rules import op10_quality_rules
from strata.llm.resampling import op13_importance_resampling
from strata.llm.secrets import op8_secret_scans
from strata.llm.simhash import op3_simhash
from strata.llm.token_files import op11_token_files
from strata.llm.toxicity import op6_toxicity


def queries():
    return {
        "op1_quality": op1_quality,
        "op2_decontamination": op2_decontamination,
        "op3_simhash": op3_simhash,
        "op4_line_dedup": op4_line_dedup,
        "op5_html_text": op5_html_text,
        "op6_toxicity": op6_toxicity,
        "op7_chat_formatting": op7_chat_formatting,
        "op8_secret_scans": op8_secret_scans,
        "op9_mixing": op9_mixing,
        "op10_quality_rules": op10_quality_rules,
        "op11_token_files": op11_token_files,
        "op12_lexical_search": op12_lexical_search,
        "op13_importance_resampling": op13_importance_resampling,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql():
    return {
        "op2_decontamination": decontamination.ORACLE_SQL,
        "op5_html_text": html_text.ORACLE_SQL,
        "op7_chat_formatting": chat.ORACLE_SQL,
        "op12_lexical_search": lexical.ORACLE_SQL,
        "op13_importance_resampling": resampling.ORACLE_SQL,
    }
