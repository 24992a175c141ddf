"""The operators' name of textloom.functions.words: the module itself, so that its limits are one."""

import sys

from textloom.functions import words

sys.modules[__name__] = words
