from starloom.streaming.incremental import (
    FileFeed,
    incremental_upsert,
    merge_batches,
    prune_batches,
)

__all__ = ["FileFeed", "incremental_upsert", "merge_batches", "prune_batches"]
