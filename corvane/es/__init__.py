"""The JSON search form: requests as dictionaries in, responses as dictionaries out. There is no HTTP server."""
