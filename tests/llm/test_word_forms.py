"""Word forms told without a pattern where none is needed."""

import random

from peerscope.llm import decontaminate


def test_plain_words_need_no_pattern(monkeypatch):
    """Words of letters alone are told without the number's pattern; all others as before."""

    class Counting:
        def __init__(self, real):
            self.real, self.seen = real, []

        def fullmatch(self, word):
            self.seen.append(word)
            return self.real.fullmatch(word)

    def slow(word):
        bare = word.strip(decontaminate._MARKS)
        low = bare.lower()
        if any(map(str.isdigit, bare)) and real.fullmatch(word.strip(".,;:!?\"'()[]{}*#&|")):
            return decontaminate.NUMBER, low, False, word[-1] in ".!?:"
        return low, None, bare[:1].isupper() and not bare.isupper() and len(bare) > 1, word[-1] in ".!?:"

    real = decontaminate._NUMBER
    counting = Counting(real)
    monkeypatch.setattr(decontaminate, "_NUMBER", counting)
    rng = random.Random(4)
    pieces = ["Ab", "B", "c", "7", "3.5", "½", "²", "٣", "$", "%", "kg", "+", "-", ".", "!", "(", "é", "ǅ", "ß", "İ", "中", "_", "@"]
    words = ["".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(4000)]
    assert [decontaminate._plain(w) for w in words] == [slow(w) for w in words]
    assert all(any(c.isdigit() for c in w) for w in counting.seen)
    counting.seen.clear()
    monkeypatch.setattr("builtins.any", lambda _: (_ for _ in ()).throw(AssertionError("letter by letter")))
    for w in ("Plain", "plain", "PLAIN", "Straße", "p"):
        decontaminate._plain(w)
    assert not counting.seen
