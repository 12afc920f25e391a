from datetime import date, datetime
from decimal import Decimal


def t(text):
    return datetime.fromisoformat(text)


def d(text):
    return date.fromisoformat(text)


def m(text):
    return Decimal(text)
