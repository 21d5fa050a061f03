"""Queries of the training-data operators, by problem number."""

from __future__ import annotations

from turnmill.llm import conversations, copies, encoding, leaks, overlap, packing, personal, pieces, runs, splits
from turnmill.llm.oracle import SQL

QUERIES = {
    "p1_found": overlap.found,
    "p1_report": overlap.report,
    "p1_by_source": overlap.by_source,
    "p2_found": copies.found,
    "p2_collapsed": copies.collapsed,
    "p3_found": conversations.found,
    "p3_transcripts": conversations.transcripts,
    "p4_found": splits.found,
    "p4_assign": splits.assign,
    "p4_balance": splits.balance,
    "p4_faults": splits.faults,
    "p5_found": personal.found,
    "p5_redacted": personal.redacted,
    "p5_by_pattern": personal.by_pattern,
    "p5_faults": personal.faults,
    "p6_found": runs.found,
    "p6_entries": runs.entries,
    "p7_found": encoding.found,
    "p7_restored": encoding.restored,
    "p7_faults": encoding.faults,
    "p8_pack": packing.packed,
    "p8_fill": packing.fill_report,
    "p8_faults": packing.faults,
    "p9_found": leaks.found,
    "p9_by_item": leaks.by_item,
    "p9_cleaned": leaks.cleaned,
    "p10_pieces": pieces.found_pieces,
    "p10_by_document": pieces.by_document,
    "p10_faults": pieces.faults,
}

__all__ = ["QUERIES", "SQL"]
