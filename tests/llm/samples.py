"""Texts that every operator must take."""

LONG = " ".join(f"word{i % 977} and, thing{i % 311}." for i in range(9000))
ODD = ["", None, "  \t\n ", "one", "One two", LONG, LONG, "É l'été İstanbul H̱ <|endoftext|> x", "日本語 тест!!! don't 12,5%", "a\x1cb c"]
