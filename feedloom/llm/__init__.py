"""Operators for preparing training text at corpus scale.

One module per operator; ``queries`` registers one thin query for each.
Nothing outside this subpackage imports it.
"""
