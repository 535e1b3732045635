"""The source analyses as DataFrame plans (loans, community lenders, bank
small-business loans, venture deals, charitable giving, local spending) and
the rank / trend / gap report tables built on them."""
