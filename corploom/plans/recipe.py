"""A run recipe: the settings that decide which sample is read when."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Recipe:
    """Intervals are batches or durations such as ``1ep``; evaluation has its own batch
    size (the training one if not given) and keeps its short last batch."""

    max_seq_len: int = 4096
    global_batch: int = 64
    max_duration: str = "1ep"
    seed: int = 17
    shuffle: bool = True
    drop_last: bool = True
    devices: int = 8
    micro_size: int = 1
    eval_interval: int | str = 5
    save_interval: int | str = 5
    eval_first: bool = False
    eval_subset_batches: int = -1
    eval_batch: int | None = None
    eval_drop_last: bool = False
    allow_pad_trimming: bool = False
    tokenizer: str = "words"
