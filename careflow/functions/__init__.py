from careflow.functions.ages import age_group, age_years
from careflow.functions.masks import mask_email, mask_name, mask_phone
from careflow.functions.times import date_text, event_time, midnight, second_text

__all__ = [
    "age_group",
    "age_years",
    "date_text",
    "event_time",
    "mask_email",
    "mask_name",
    "mask_phone",
    "midnight",
    "second_text",
]
