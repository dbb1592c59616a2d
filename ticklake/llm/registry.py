"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from ticklake.llm.chat_format import OP3_SQL, op3_preference_format
from ticklake.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from ticklake.llm.fill_middle import OP12_SQL, op12_fill_in_middle
from ticklake.llm.media import op6_chroma_fingerprints
from ticklake.llm.mixing import op8_mix
from ticklake.llm.ngram_join import OP1_SQL, op1_ngram_join
from ticklake.llm.packing import op10_pack
from ticklake.llm.periodic_runs import op13_periodic_runs
from ticklake.llm.quality import op9_quality
from ticklake.llm.simhash import op11_simhash
from ticklake.llm.substring_dedup import OP2_SQL, op2_substring_dedup
from ticklake.llm.suffix_dedup import op5_suffix_dedup
from ticklake.llm.url_filter import op7_url_filter

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_preference_format": op3_preference_format,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_chroma_fingerprints": op6_chroma_fingerprints,
    "op7_url_filter": op7_url_filter,
    "op8_mix": op8_mix,
    "op9_quality": op9_quality,
    "op10_pack": op10_pack,
    "op11_simhash": op11_simhash,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL = {"op1_ngram_join": OP1_SQL, "op2_substring_dedup": OP2_SQL, "op3_preference_format": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op12_fill_in_middle": OP12_SQL}
