"""Operations on training text: scoring, privacy, quality, search, formatting, mixing, packing, near copies.

Nothing outside this folder imports it. Methods and their inputs are described in each module.
"""
