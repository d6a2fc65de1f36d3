"""Tables composed from the operators, and the end-to-end runs that write them."""
