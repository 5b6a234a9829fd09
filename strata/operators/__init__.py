"""DataFrame operators: cleaning, features, ranking, marts, questions, trends, ML."""
