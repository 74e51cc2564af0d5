"""Column expressions; all are Spark built-ins that stay in the JVM."""

from eventpulse.functions.share import linear_scale, percent_half_up
from eventpulse.functions.text import longer_than_one, sentence_array, trim_blanks, word_array
from eventpulse.functions.time import event_millis, millis_of_ntz

__all__ = [
    "event_millis", "linear_scale", "longer_than_one", "millis_of_ntz",
    "percent_half_up", "sentence_array", "trim_blanks", "word_array",
]
