#: Texts for the edge cases that every operator must stand: null, empty, blank, repeated, very long.
ODD = [None, "", " \n\t ", "a", "same text here", "same text here", "SAME TEXT HERE", "é ü 　 日本語 😀", "x" * 50_000, "word " * 20_000, "\x00nul\x00", "line\nline\nline\n"]
