"""Names that a text gives with a title once and without it elsewhere."""

from pressmill.llm import pii


def test_untitled_mentions_get_the_same_surrogate():
    text = "Byron came. Mrs Ada Byron wrote to Mr Li; Ada\nByron said so, Byron's friend Li too. Byronic, byron@example.com, Liar, Byron-Li and Byron_2 are others."
    new, n = pii.replace(text, b"key")
    ada, byron, li = (pii.surrogate(b"key", k, e) for k, e in (("name_f", "Ada"), ("family", "Byron"), ("family", "Li")))
    email = pii.surrogate(b"key", "email", "byron@example.com")
    assert new == (f"{byron} came. Mrs {ada} {byron} wrote to Mr {li}; {ada}\n{byron} said so, {byron}'s friend {li} too. "
                   f"Byronic, {email}, Liar, Byron-Li and Byron_2 are others.")
    assert n == 9


def test_texts_without_a_titled_name_stay():
    assert pii.replace("Byron and Ada Byron", b"key") == ("Byron and Ada Byron", 0)


def test_possessives_name_the_same_family():
    family = pii.surrogate(b"key", "family", "O'Brien")
    assert pii.replace("Mrs O'Brien's dog. O'Brien’s cat", b"key") == (f"Mrs {family}'s dog. {family}’s cat", 2)
