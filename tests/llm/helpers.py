"""Helpers of the llm tests."""


def words(random, n, kinds=50):
    """n words of `kinds` different ones, with a space between."""
    return " ".join("w" + "".join("klmnopqrst"[int(c)] for c in str(random.randrange(kinds))) for _ in range(n))
