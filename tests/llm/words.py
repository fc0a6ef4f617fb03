import random

_SYLLABLES = {"a": "the ing and ou re ti th st sh wh an ed".split(), "b": "aux ei ç qu é la oi eu ña ión ü le".split()}


def prose(kind: str, seed: int, n: int) -> str:
    """``n`` invented words of one of two languages."""
    draw = random.Random(f"{kind}{seed}")
    return " ".join("".join(draw.choices(_SYLLABLES[kind], k=draw.randint(1, 4))) for _ in range(n))
