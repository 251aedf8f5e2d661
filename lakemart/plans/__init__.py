"""The mart: calendar, dimensions, facts, reports, metrics and dashboard cards.

Every function takes DataFrames and returns a lazy DataFrame. Only month lists, holidays, cost
categories and the like, whose size the calendar or a fixed list bounds, carry a broadcast hint;
dimensions do not, since they grow with the company: the optimizer decides from their real size.
"""
