"""Input-output roles played by a star schema of orders and events.

The operators of the library are run here on ordinary business tables: a
supplier's nation and a part's brand are the producer, a customer's nation and
a sector derived from the customer are the user, and the line price is the
flow between them.
"""
