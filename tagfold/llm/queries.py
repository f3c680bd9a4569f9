"""The registered queries of the operators, over their whole tables."""

from __future__ import annotations

from . import hostrules, jaccard, preference, suffixes, warc
from .common import prepare, table
from .decontam import find_leaks
from .hostrules import quality_rules
from .jaccard import join_near_copies
from .langid import identify_languages
from .merkle import merkle_proofs
from .packing import pack_documents
from .pii import find_personal_data
from .preference import format_derived_preferences
from .secret_scan import scan_secrets
from .shards import shard_documents
from .spelling import spelling_variants
from .suffixes import remove_repeats
from .warc import archive_pages


def _over(operator, *tables):
    def run(spark, sf_dir):
        prepare(spark)
        return operator(*(table(spark, sf_dir, t) for t in tables))
    run.__name__ = operator.__name__
    return run


QUERIES = {
    "op1_slot_shards": _over(shard_documents, "documents"),
    "op2_nnls_packing": _over(pack_documents, "documents"),
    "op3_semi_crf_pii": _over(find_personal_data, "documents"),
    "op4_jaccard_metric_join": _over(join_near_copies, "documents"),
    "op5_preference_format": _over(format_derived_preferences, "conversations"),
    "op6_suffix_family": _over(remove_repeats, "documents"),
    "op7_bitmask_langid": _over(identify_languages, "documents"),
    "op8_host_rules": _over(quality_rules, "documents"),
    "op9_randomness_secrets": _over(scan_secrets, "documents"),
    "op10_bm25_decontam": _over(find_leaks, "documents", "benchmark"),
    "op11_chunked_warc": _over(archive_pages, "pages"),
    "op12_vgram_spelling": _over(spelling_variants, "documents"),
    "op13_postorder_merkle": _over(merkle_proofs, "documents"),
}

ORACLE_SQL: dict[str, str] = {
    "op4_jaccard_metric_join": jaccard.ORACLE,
    "op5_preference_format": preference.ORACLE,
    "op6_suffix_family": suffixes.ORACLE,
    "op8_host_rules": hostrules.ORACLE,
    "op11_chunked_warc": warc.ORACLE,
}
