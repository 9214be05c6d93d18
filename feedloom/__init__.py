"""feedloom: customer-feedback analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrames (plus parameters) to a
DataFrame.  Nothing data-sized passes through the driver; the few eager actions
fetch counts or a single looked-up row.
"""
