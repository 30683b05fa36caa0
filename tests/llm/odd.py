"""Odd rows that every operator over documents meets."""

LONG = " ".join(f"word{i % 977} the of" for i in range(40_000))
ODD = [(1, "plain words of a short text, nothing else in it"), (2, None), (3, ""), (4, " \n\t "), (None, "a text without an id but with words"),
       (5, "same row twice here, the same row"), (5, "same row twice here, the same row"), (6, LONG), (7, "日本語 é 123 ###"), (8, "12345 !!! ###")]
