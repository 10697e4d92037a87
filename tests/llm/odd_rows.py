"""Rows that every operator must stand."""

#: Ids: usual, null, repeated; texts: null, empty, blank, repeated, very long; other columns named like inner ones.
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \n\t ", "b"),
    (5, "the quick brown fox jumps over the lazy dog near the old river bank today", "b"),
    (5, "the quick brown fox jumps over the lazy dog near the old river bank today", "b"),
    (6, LONG, "c"),
    (None, "A text without an id, with five words and more", "c"),
    (7, "Ünïcödé wörds 日本語 😀 mixed with\nseveral lines of text\nseveral lines of text here", None),
    (8, "*** $$$ ###", "a"),
]
CLASHING = ["key", "node", "id", "mark", "block", "copy", "line", "n", "size", "score", "spans", "media", "token_ids", "rank"]
