"""Invented texts for the tests of the corpus operators."""

WORDS = "the of and to in that it was for on are as with his they at be this from have or one had".split()


def prose(rng, n):
    return " ".join(WORDS[i] + str(rng.integers(0, 40)) for i in rng.integers(0, len(WORDS), n))
