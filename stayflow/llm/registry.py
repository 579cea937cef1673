"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import functools

from stayflow.llm import (
    _store,
    attention_mil,
    backtracking_bpe,
    bwt_repeats,
    chat_rotation,
    dialogue_repair,
    epsilon_grid,
    histogram_packing,
    merge_replay,
    minhash_bayes,
    periodic_runs,
    quality_trees,
    record_files,
    url_trie,
)


def _query(function):
    @functools.wraps(function)
    def run(spark, sf_dir):
        _store.share_package(spark)
        return function(spark, sf_dir)

    return run


SPARK = {f.__name__: _query(f) for f in (
    minhash_bayes.op1_minhash_near_dedup,
    epsilon_grid.op2_epsilon_grid_join,
    attention_mil.op3_quality_classifier,
    bwt_repeats.op4_bwt_repeats,
    histogram_packing.op5_histogram_packing,
    url_trie.op6_url_filter,
    record_files.op7_record_files,
    quality_trees.op8_quality_rules,
    merge_replay.op9_merge_replay,
    chat_rotation.op10_chat_rotation,
    backtracking_bpe.op11_backtracking_bpe,
    periodic_runs.op12_periodic_runs,
    dialogue_repair.op13_dialogue_repair,
)}

ORACLE = {
    "op6_url_filter": url_trie.OP6_SQL,
    "op10_chat_rotation": chat_rotation.OP10_SQL,
}
