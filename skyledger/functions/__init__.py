"""Column functions: Column in, Column out, all evaluated in the JVM."""

from .clock import day_path, iso_text, time_digits, utc_iso_now
from .pixels import colour_mode, pixel_sample
from .text import base_name, callsign, coded, first_word, stripped, titled, words

__all__ = [
    "base_name", "callsign", "coded", "colour_mode", "day_path", "first_word", "iso_text",
    "pixel_sample", "stripped", "time_digits", "titled", "utc_iso_now", "words",
]
