import random

import pytest

SYLLABLES = {
    "en": "the and tion er ing es on re th in an wh ly".split(),
    "de": "sch ung keit ver ge ein ich ber ß ä au en tz".split(),
    "fr": "eau que é è tion ment ou ai eux on re le ç".split(),
}


@pytest.fixture(scope="session")
def prose():
    """prose(seed, words, lang): invented text, the same for the same arguments."""

    def make(seed, words, lang="en", line=12):
        rng = random.Random(f"{seed}-{lang}")
        out = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words)]
        return "\n".join(" ".join(out[i : i + line]) for i in range(0, words, line))

    return make


@pytest.fixture
def documents(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make
