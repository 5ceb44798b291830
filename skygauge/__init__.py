"""Weather-hazard analytics as Spark DataFrame and Structured Streaming transformations.

``sources``    reading and writing observations, messages and zones
``functions``  column expressions: hazard rules, risk bands, calendar terms
``operators``  DataFrame to DataFrame steps: cleaning, features, labels, serving, evaluation, learning
``streaming``  the same steps on unbounded input
``plans``      named queries that chain the steps over the tables of a data folder
"""
