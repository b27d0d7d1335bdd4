"""The registered queries: driver tables standing in for the four feeds."""
