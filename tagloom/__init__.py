"""Tag records, rename commands and event counters as Spark DataFrame transformations."""

from .operators.cards import (
    current_tag_outputs,
    line_changes,
    tag_cards,
    tag_lines,
    tag_outputs,
    write_cards,
)
from .operators.counters import (
    double_counter,
    event_counter,
    event_counts,
    once_per_event,
    running_counter,
    running_counter_from,
    running_counter_global,
    with_zero_counts,
)
from .operators.quality import (
    duplicate_chip_keys,
    duplicate_chip_keys_per_row,
    json_prop_violations,
    prop_violations,
    text_contains,
)
from .operators.renames import (
    accepted_renames,
    current_tags,
    latest_names,
    rename_audit,
    unknown_tag_commands,
    with_names,
)
from .operators.sections import (
    tag_chips,
    tag_fields,
    tag_section_entries,
    tag_sections,
    tag_titles,
)
from .session import drop_folder
from .sources.bucketed import only_keys, read_bucketed, write_bucketed
from .sources.text_index import indexed_text_contains, write_text_index
from .sources.tags import golden_tags, read_tags, split_records, stream_tags, write_tags

__all__ = [
    "accepted_renames",
    "current_tag_outputs",
    "current_tags",
    "double_counter",
    "drop_folder",
    "duplicate_chip_keys",
    "duplicate_chip_keys_per_row",
    "event_counter",
    "event_counts",
    "golden_tags",
    "indexed_text_contains",
    "json_prop_violations",
    "latest_names",
    "line_changes",
    "once_per_event",
    "only_keys",
    "prop_violations",
    "read_bucketed",
    "read_tags",
    "rename_audit",
    "running_counter",
    "running_counter_from",
    "running_counter_global",
    "split_records",
    "stream_tags",
    "tag_cards",
    "tag_chips",
    "tag_fields",
    "tag_lines",
    "tag_outputs",
    "tag_section_entries",
    "tag_sections",
    "tag_titles",
    "text_contains",
    "unknown_tag_commands",
    "with_names",
    "with_zero_counts",
    "write_bucketed",
    "write_cards",
    "write_tags",
    "write_text_index",
]
