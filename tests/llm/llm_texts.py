import random


def prose(seed: int, count: int) -> str:
    chance = random.Random(seed)
    letters = "abcdefgäé"
    return " ".join("".join(chance.choice(letters) for _ in range(chance.randint(1, 6))) for _ in range(count))
