"""Jobs built from the operators: batch layer, serving layer, registered queries."""
