import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text, lower=False):
    """Words of a text by the shared rule."""
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)
