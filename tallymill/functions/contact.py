"""Phone and e-mail repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
SAFE_PREFIX = "0"
DOUBLED_PREFIX = {"7": "07", "1": "01"}
COUNTRY_MOBILE = "2547"


def digits(phone: Column) -> Column:
    """Phone without blanks, dashes and plus signs."""
    return F.trim(F.translate(phone, " -+", ""))


def local_phone(phone: Column, compat: bool = True) -> Column:
    """National form of a cleaned phone number.

    ``compat`` repeats the source system's habit of putting ``07``/``01`` before
    nine digits that already start with 7 or 1; without it a single 0 is added.
    """
    n = F.length(phone)
    out = F.when((n == 12) & phone.startswith(COUNTRY_MOBILE), F.concat(F.lit("0"), F.right(phone, F.lit(9))))
    for lead, prefix in DOUBLED_PREFIX.items():
        put = prefix if compat else SAFE_PREFIX
        out = out.when((n == 9) & phone.startswith(lead), F.concat(F.lit(put), phone))
    return out.otherwise(phone)


def phone_valid(phone: Column) -> Column:
    return F.coalesce(phone.rlike("^[0-9]{10,12}$"), F.lit(False))


def email_domain(email: Column) -> Column:
    return F.when(email.contains("@"), F.substr(email, F.locate("@", email) + 1))


def email_valid(email: Column) -> Column:
    """Something, @, at least two characters, a dot and at least two more."""
    return F.coalesce(email.rlike("(?s)^.+@.{2,}\\..{2,}$"), F.lit(False))


def mail_host(email: Column, placeholder: str, host: str) -> Column:
    return F.trim(F.lower(F.replace(email, F.lit(placeholder), F.lit(host))))
