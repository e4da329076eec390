"""seqweave: pack chat conversations into fixed-budget training sequences on Spark.

The pipeline is a chain of DataFrame jobs:

    read (JSONL folder or turns table) -> validate -> render chat template
    -> tokenize -> training fields -> exact next-fit-decreasing packing
    -> sink (Arrow IPC stream, JSONL, Parquet)

Everything heavy is expressed with built-in Spark column functions, joins,
aggregations and windows.  Python runs only on bounded inputs (the per-file
length histogram walked by the packing plan) or as an optional Arrow-batched
tokenizer.
"""

from seqweave.functions.fields import labels_for, position_ids_for, truncate_ids
from seqweave.functions.template import ChatTemplate, RoleRule, SystemBlock
from seqweave.functions.tokenizers import (
    CodePointTokenizer,
    PretrainedTokenizer,
    WordVocabulary,
)
from seqweave.operators.packing import PackSpec, assign_bins, clip_payload, materialize_bins
from seqweave.operators.ranking import length_histogram, rank_by_length
from seqweave.plans.job import (
    pack_conversations,
    pack_job,
    pack_lines,
    pack_report,
    tokenize_conversations,
)
from seqweave.session import checkpoint_dir, get_session
from seqweave.sources.jsonl import line_counts, read_conversations
from seqweave.sources.turns import conversations_from_turns
from seqweave.sources.validate import check_messages
from seqweave.streaming.continuous import start_continuous_pack

__all__ = [
    "ChatTemplate",
    "CodePointTokenizer",
    "PackSpec",
    "PretrainedTokenizer",
    "RoleRule",
    "SystemBlock",
    "WordVocabulary",
    "assign_bins",
    "check_messages",
    "checkpoint_dir",
    "clip_payload",
    "conversations_from_turns",
    "get_session",
    "labels_for",
    "length_histogram",
    "line_counts",
    "materialize_bins",
    "pack_conversations",
    "pack_job",
    "pack_lines",
    "pack_report",
    "position_ids_for",
    "rank_by_length",
    "read_conversations",
    "start_continuous_pack",
    "tokenize_conversations",
    "truncate_ids",
]
