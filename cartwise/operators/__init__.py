"""Relational operators of the engine (all lazy DataFrame transformations)."""

from cartwise.operators.basket import Basket  # noqa: F401
