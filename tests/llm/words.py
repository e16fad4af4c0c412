import random


def prose(seed, n, vocabulary=5000):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))
