import pytest


@pytest.fixture
def words():
    """Pseudo-random prose: deterministic for a seed."""
    import random

    def make(n, seed, vocabulary=300):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))

    return make
