"""The subpackage's queries and their SQL."""

from __future__ import annotations

from feedspark.llm.counts import op9_token_counts
from feedspark.llm.decontaminate import OP10_SQL, op10_decontamination
from feedspark.llm.exact import OP2_SQL, op2_exact_dedup
from feedspark.llm.language import op5_language
from feedspark.llm.licenses import op8_license_scan
from feedspark.llm.negatives import OP13_SQL, op13_hard_negatives
from feedspark.llm.overlaps import OP12_SQL, op12_minhash
from feedspark.llm.packing import op7_packing
from feedspark.llm.simhash import op4_simhash
from feedspark.llm.sstable import op1_token_shards
from feedspark.llm.substring import OP3_SQL, op3_substring_dedup
from feedspark.llm.urls import op6_url_filter
from feedspark.llm.whitening import op11_whitening

QUERIES = {
    f.__name__: f
    for f in (op1_token_shards, op2_exact_dedup, op3_substring_dedup, op4_simhash, op5_language, op6_url_filter, op7_packing, op8_license_scan, op9_token_counts, op10_decontamination, op11_whitening, op12_minhash, op13_hard_negatives)
}
SQL = {"op2_exact_dedup": OP2_SQL, "op3_substring_dedup": OP3_SQL, "op10_decontamination": OP10_SQL, "op12_minhash": OP12_SQL, "op13_hard_negatives": OP13_SQL}
