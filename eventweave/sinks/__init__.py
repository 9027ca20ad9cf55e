"""Writers: idempotent appends, insert-once, keyed upsert, publish, export, bulk load."""
