"""Row-local Column builders (no shuffle): param lookups, click-id override,
channel and language classifiers, date helpers."""
