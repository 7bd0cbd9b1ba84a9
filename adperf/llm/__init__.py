"""Training-data operators (document fingerprints to URL filters). Nothing else in the library imports this."""
