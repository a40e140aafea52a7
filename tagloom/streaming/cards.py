"""Cards of a stream of tag records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..operators.cards import tag_cards, write_cards
from ..schema import KEY


def cards_files(
    out: str, fmt: str = "json", partition_by: Sequence[str] = (), key: str = KEY
) -> Callable[[DataFrame, int], None]:
    """For a stream of tags: a folder of cards per batch, written anew if played again."""

    def on_batch(tags: DataFrame, batch_id: int) -> None:
        folder = f"{out}/batch_id={batch_id}"
        write_cards(tag_cards(tags, key), folder, fmt, partition_by, "overwrite")

    return on_batch
